"""Job spec and job metadata as JSON text.

F6 fills substring placeholders in a template. Unlike a raw text replace, the
inserted values are JSON-escaped, so the spec is always valid JSON.
F7 works on the parsed JSON of every row: it replaces string *values* that equal
a placeholder exactly (keys are never touched) and sets the top-level
``main_*_file`` fields. All of it is JVM-side expressions.
F8 builds the nested metadata struct (optional ``watch`` section, nullable
file fields) and serialises it with nulls kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Placeholder spellings (both the three- and four-percent
# closing forms are accepted for the reference-file placeholders).
INPUT_PH = "%%%INPUT%%%"
OUTPUT_PH = "%%%OUTPUT%%%"
FASTA_PHS = ("%%%FASTA%%%", "%%%FASTA%%%%")
SPIKE_PHS = ("%%%SPIKE%%%", "%%%SPIKE%%%%")

# The top-level keys that are set or read by name.
INPUT_KEY, OUTPUT_KEY = "main_input_folder", "main_outdir"
FASTA_KEY, SPIKE_KEY = "main_fasta_file", "main_spike_file"

MARK = "\x01"  # stands for a placeholder while others are filled

# A job template of our own: the named keys, and sections whose leaves show
# every kind of value.
JOB_TEMPLATE = """{
  "main_input_folder": "%%%INPUT%%%",
  "main_outdir": "%%%OUTPUT%%%",
  "main_fasta_file": "%%%FASTA%%%",
  "labels": {"title": "nightly run", "owner": null, "tags": ["a", "%%%SPIKE%%%%", "%%%FASTA%%%%"]},
  "retry": {"attempts": 3, "backoff": 1.5, "enabled": true},
  "lookup": {"table": "%%%SPIKE%%%%", "main_fasta_file": "nested, left alone", "hint": "see %%%FASTA%%% in the manual"},
  "nothing": {}
}"""

# Field names of the metadata file (an input format).
METADATA_SCHEMA = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("paths", T.StructType([
        T.StructField("hash_dir", T.StringType()),
        T.StructField("tmp_input_dir", T.StringType()),
        T.StructField("tmp_output_dir", T.StringType()),
        T.StructField("spec_json", T.StringType()),
        T.StructField("source_file", T.StringType()),
    ])),
    T.StructField("source", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("absolute_path", T.StringType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("is_dir", T.BooleanType()),
    ])),
    T.StructField("fasta", T.StructType([
        T.StructField("dir", T.StringType()),
        T.StructField("file", T.StringType()),
    ])),
    T.StructField("spike", T.StructType([
        T.StructField("dir", T.StringType()),
        T.StructField("file", T.StringType()),
    ])),
    T.StructField("watch", T.StructType([
        T.StructField("input_root", T.StringType()),
        T.StructField("final_output_root", T.StringType()),
        T.StructField("pattern", T.StringType()),
        T.StructField("interval_seconds", T.IntegerType()),
        T.StructField("ignore_files", T.ArrayType(T.StringType())),
    ])),
])


def json_string(s: Column) -> Column:
    """A string as a JSON string literal, quotes included (null stays null)."""
    whole = F.to_json(F.struct(s.alias("v")))  # {"v":"..."}
    return F.when(s.isNotNull(), F.substr(whole, F.lit(6), F.length(whole) - 6))


def json_escape(s: Column) -> Column:
    """Escape a string for use inside a JSON string literal."""
    quoted = json_string(s)
    return F.substr(quoted, F.lit(2), F.length(quoted) - 2)


def replace_all(text: Column, rx: str, by: Column) -> Column:
    """Every match of ``rx`` replaced by a column's value, taken as it is."""
    return F.call_function("array_join", F.split(text, rx), by)


def fill_io(template: Column, input_dir: Column, output_dir: Column) -> Column:
    """substitute the input/output placeholders (values JSON-escaped). What a
    value holds is never filled again: the input's places are marked by a control
    character first, which neither JSON text nor an escaped value has."""
    marked = F.replace(template, F.lit(INPUT_PH), F.lit(MARK))
    return F.replace(F.replace(marked, F.lit(OUTPUT_PH), json_escape(output_dir)), F.lit(MARK), json_escape(input_dir))


def set_reference(spec: Column, path: Column, placeholders: tuple[str, ...], field: str) -> Column:
    """F7 on a column of spec texts, each with a structure of its own. String
    leaves equal to a placeholder become ``path`` (keys are never touched), and
    the top-level ``field`` is set, whatever it was. Without a path, and for text
    that isn't a JSON object, the text is returned as it is.

    The text is parsed (VARIANT) and written again, so every string stands in one
    form, between quotes that nothing else can hold unescaped; a leaf is such a
    string that no colon follows."""
    doc = F.try_parse_json(spec)
    is_object = F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    fields = F.when(is_object, doc).cast("map<string,variant>")
    mine = F.create_map(F.lit(field), path.cast("variant"))
    written = F.to_json(F.map_concat(F.map_filter(fields, lambda k, _: k != field), mine))
    names = "|".join(sorted((p for p in placeholders), key=len, reverse=True))
    filled = replace_all(written, f'(?<!\\\\)"(?:{names})"(?!:)', json_string(path))
    return F.when(path.isNotNull() & is_object, filled).otherwise(spec)


def fill_reference(df: DataFrame, spec: str, file_path: Column, placeholders: tuple[str, ...],
                   field: str) -> DataFrame:
    """F7 on column ``spec``."""
    return df.withColumn(spec, set_reference(F.col(spec), file_path, placeholders, field))


def metadata_json(meta: Column) -> Column:
    """F8: serialise the metadata struct, keeping null fields."""
    return F.to_json(meta, {"ignoreNullFields": "false"})
