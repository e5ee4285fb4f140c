import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from intake_spark.session import get_session  # noqa: E402

SF = {k: f"/root/testdata/sf{k}" for k in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", 8)
    # tests own the checkpoint folder; a cluster names a shared one
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="intake-test-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def connect(sf_dir):
        con = duckdb.connect()
        for t in ("region nation customer supplier part orders lineitem events documents embeddings "
                  "pages benchmark labels conversations").split():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con
    return connect
