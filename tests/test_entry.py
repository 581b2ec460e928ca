import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as E
from candlewick.plans import registry


def test_entry_runs_and_has_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "calculated_at" not in df.columns and "open_price" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    qs, sql = registry.queries(), registry.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 70
    assert set(qs) - set(sql) == {"tick_to_json"}   # its decoded fields are tick_to_json_fields


def test_queries_that_write_nothing_resolve_their_schema(spark):
    # the values are compared by tools/oracle_check.py
    for k, fn in registry.queries().items():
        if k in {"scan_parquet", "roundtrip_partitioned", "partition_counts", "orc_roundtrip", "upsert_merge",
                 "upsert_all_grains", "table_file_rows", "compact_ticks", "stream_ingest", "stream_candles_1h",
                 "stream_dedup", "stream_events"}:
            continue  # these write before returning; covered by the oracle run
        assert fn(spark, "/root/testdata/sf0.001").schema is not None, k


COUNT = "import __spark_entry__ as E; print(len(E.queries()), sum(k == 'pipeline' or k.startswith('op') and k[2].isdigit() for k in E.queries()))"


def _listed(folder, before=""):
    out = subprocess.run([sys.executable, "-c", before + COUNT], cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(folder)})
    return out.stdout.split(), out.stderr


def _copy(tmp_path, *left_out):
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(root, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", *left_out))
    return tmp_path / "copy"


@pytest.mark.parametrize("left_out", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_entry_works_without_the_optional_folders(tmp_path, left_out):
    """The rest of the library neither needs nor imports the training-data operators, also if the pipeline's file is left behind."""
    out, err = _listed(_copy(tmp_path, *left_out))
    assert out == [str(len(registry.queries())), "0"], err


def test_a_leftover_cache_folder_is_no_subpackage(tmp_path):
    copy = _copy(tmp_path, "llm")
    (copy / "candlewick" / "llm" / "__pycache__").mkdir(parents=True)
    out, err = _listed(copy)
    assert out == [str(len(registry.queries())), "0"], err


def test_a_missing_optional_library_leaves_the_other_queries(tmp_path):
    out, err = _listed(_copy(tmp_path), "import sys; sys.modules['zstandard'] = None; ")
    assert out == [str(len(registry.queries())), "0"], err
