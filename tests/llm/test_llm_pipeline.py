import corpus_pipeline as P
from candlewick.llm import decontaminate, quality
from candlewick.llm.common import shared_folder, table
from test_llm_decontaminate import norm
from test_llm_packing import check
from test_llm_simhash import closure, fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs, kept = table(spark, SF, "documents"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(P.STAGES):
        path = f"{shared_folder(spark, 'test-pipeline')}/{k}"
        stage(spark, docs, SF).write.parquet(path)
        before = {r["doc_id"]: r for r in docs.collect()} if k < 4 else {}
        docs = spark.read.parquet(path)
        assert name == "packing" or docs.columns == columns
        kept[name] = {r["doc_id"]: r for r in docs.collect()} if k < 4 else docs.collect()
        if name == "quality":
            scored = {r["doc_id"] for r in quality.op1_quality_classifier(spark, SF).where("predicted = 1").collect()}
            assert set(kept[name]) == scored and 0 < len(scored) < len(before)
        elif name == "line_dedup":
            assert all(set(r["text"].split("\n")) <= set(before[d]["text"].split("\n")) for d, r in kept[name].items())
        elif name == "near_dedup":
            prints = {d: fingerprint(r["text"]) for d, r in before.items()}
            groups = closure([(a, b) for a in prints for b in prints if a <= b and (prints[a] ^ prints[b]).bit_count() <= 3])
            assert set(kept[name]) == set(groups.values())
        elif name == "decontaminate":
            bench = [r["text"] for r in table(spark, SF, "benchmark").collect()]
            leaks = {d for d, r in before.items() if any(norm(x) in norm(r["text"]) for x in bench)}
            gone = set(before) - set(kept[name])
            assert leaks <= gone and len(gone) <= len(leaks) + 2
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(P.packing.vocabulary_path("word_bpe_49k.json"))
    check(kept["packing"], {d: r["text"] for d, r in kept["decontaminate"].items()}, tokenizer, 2048)


def test_nulls_extra_columns_and_empty_table(spark):
    given = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, "s", 0), (-1, "", None, "s", 0)], given.schema)
    docs = given.unionByName(odd).selectExpr("*", "'p' as place", "1 as score", "'r' as `row`", "2 as length", "3 as _lines_removed", "4 as drops")
    for name, stage in P.STAGES:
        path = shared_folder(spark, "test-odd")
        stage(spark, docs, SF).write.parquet(path)
        if name != "packing":
            assert spark.read.parquet(path).columns == docs.columns
        assert spark.read.parquet(path).count() > 0
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert decontaminate.clean(odd, table(spark, SF, "benchmark")).count() == 3
