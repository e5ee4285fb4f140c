"""PySpark toolkit for file-intake analytics: stability detection over scan
logs, include/ignore pattern filters, directory roll-ups, de-duplicated
intake, job life-cycle ledgers and artifact delivery."""

__version__ = "0.1.0"
