from data import ROWS, WORDS, documents

import corpus_pipeline as p

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = documents(spark).select(*p.COLUMNS)
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == p.COLUMNS, name
        assert stage(spark, documents(spark, []).select(*p.COLUMNS), SF).count() == 0
    assert {r.doc_id for r in p.language_id(spark, docs, SF).collect()} >= {1, 5, 6, 7, 8}
    kept = {r.doc_id: r for r in p.dedup_lines(spark, docs, SF).collect()}
    # The null id is first, so its copy of the shared line stays.
    assert kept[7].text == "own line seven" and kept[8].text == "own line eight\n\nend"
    assert kept[9].text == f"{WORDS} and one more" and kept[2].text is None
    near = [r.doc_id for r in p.dedup_near(spark, docs, SF).collect()]
    assert near.count(1) == 1 and 6 not in near and {2, 3, 4} & set(near) == {2}
    assert len(near) == len(set(near) - {None}) + near.count(None)


def test_extra_columns_of_the_stages_own_names(spark):
    from pyspark.sql import functions as F
    names = ["row", "kept", "fp", "pick", "root", "gone", "oid", "score", "lang_pred", "words"]
    docs = documents(spark).select(*p.COLUMNS, *[F.lit(7).alias(n) for n in names])
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert {tuple(r)[5:] for r in out.collect()} == {(7,) * len(names)}, name


def test_run(spark):
    rows = p.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0.7 * docs.count() < len(rows) <= docs.count()
    assert len({r.doc_id for r in rows}) == len(rows)
    assert all(r.n_tokens > 0 for r in rows)
    assert len(ROWS) == 16
