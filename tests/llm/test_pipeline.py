"""Each stage on what its predecessor kept, against brute force."""

from pyspark.sql import functions as F

import corpus_pipeline

from . import test_decontaminate, test_simhash, test_substrings
from .helpers import saved


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, kept = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = spark.createDataFrame(kept[-1], before.schema) if kept[-1] else before.limit(0)
        found = stage(spark, docs, data)
        rows = found.collect()
        old, new = {r.doc_id: r for r in kept[-1]}, {r.doc_id: r for r in rows}
        assert len(new) == len(rows) and set(new) <= set(old), name
        if name != "source_mix":
            assert found.columns == columns
        plain = [(d, r.text) for d, r in old.items()]
        if name == "language_id":
            assert {d for d, r in old.items() if any(c.isalpha() for c in r.text)} == set(new)
        elif name == "near_dedup":
            assert sorted(map(str, new)) == sorted({c for _, _, c in test_simhash.brute_components(plain)})
        elif name == "suffix_dedup":
            expected = {b[0]: b for b in test_substrings.brute(plain)}
            for d, r in old.items():
                size = expected[str(d)][1] - expected[str(d)][2]
                assert d in new or size < 8 or not r.text.strip()
                if d in new:
                    assert size <= len(new[d].text.encode()) <= size + 8 * expected[str(d)][3] and new[d].n_chars == len(new[d].text)
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
            assert set(new) == {int(b[0]) for b in test_decontaminate.brute(plain, items) if not b[5]}
        else:
            assert all(0 < r.taken <= 2 * r.size for r in rows)
        kept.append(rows if name != "source_mix" else [])
        docs = found


def test_run(spark, data):
    found = corpus_pipeline.run(spark, data)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "taken"]
    rows = found.collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_stages_with_clashing_columns(spark, data, tmp_path):
    names = "size source_size target taken row mark key n __lang __score __words __hits __items __n_hit __contaminated __stays __n fp component_id d m c copy first last cut __doc __d __m".split()
    docs = spark.read.parquet(f"{data}/documents.parquet")
    wide = docs.withColumns({n: F.lit("x") for n in names})
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, wide, data).write.parquet(f"{tmp_path}/wide-{name}")
        got = spark.read.parquet(f"{tmp_path}/wide-{name}")
        assert got.count() == stage(spark, docs, data).count()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert got.columns == wide.columns and got.where("__n <> 'x' or row <> 'x' or size <> 'x'").count() == 0


NULLS = [
    (None, "the house and the garden are very green and quiet today " * 3, "en", None, None), (1, None, None, None, 3), (2, "", "en", "a", None), (None, None, None, None, None),
    (3, "the river runs past the old mill and under the stone bridge " * 3, "en", "a", 1), (4, "the garden has many trees and the house has many rooms " * 3, None, "b", 1),
]


def test_stages_with_nulls_and_repeated_rows(spark, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    d = spark.createDataFrame(NULLS + NULLS[:1], kind)
    benchmark = spark.createDataFrame([(1, "no such words are in any of these texts at all"), (None, None), (2, "")], "item_id long, text string")
    folder = saved(spark, tmp_path, documents=d, benchmark=benchmark)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, d, folder)
        assert found.columns[:5] == d.columns or name == "source_mix"
        texts = [r.text for r in found.collect()]
        # clean documents stay, whatever of them is null
        assert {r[1][:30] for r in NULLS if r[1]} == {t[:30] for t in texts if t}, name
    assert corpus_pipeline.run(spark, folder).count() == 3


def test_run_on_empty_tables(spark, tmp_path):
    d = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    folder = saved(spark, tmp_path, documents=d, benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, folder).count() == 0
