import zlib

from data import ROWS, documents

from tidegate.llm.sharding import ROW_BYTES, histogram_sort

SF = "/root/testdata/sf0.01"


def check(rows, shards, allowed):
    sizes = [0] * shards
    slots = [[] for _ in range(shards)]
    for row in rows:
        sizes[row.shard] += row["size"]
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    mean = sum(sizes) / shards
    assert max(abs(s - mean) for s in sizes) <= allowed
    return sizes


def test_shards_of_documents_are_equal_and_gapless(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = histogram_sort(df, 24).collect()
    assert len(rows) == df.count()
    largest = max(r["size"] for r in rows)
    mean = sum(r["size"] for r in rows) / 24
    # Each splitter is within the tolerance or half a row of its place.
    check(rows, 24, 2 * max(0.02 * mean, largest))
    texts = {r.doc_id: r.text for r in df.collect()}
    for row in rows:
        data = texts[row.doc_id].encode()
        assert (row["size"], row.text_crc32) == (len(data) + ROW_BYTES, zlib.crc32(data))
        assert row.law == "bytes" and row.grown_shard is None


def test_one_text_in_most_rows_is_cut_by_id(spark):
    rows = [(i, "same text" if i % 4 else f"text {i}", "en") for i in range(4000)]
    got = histogram_sort(documents(spark, rows), 8, 0.02).collect()
    check(got, 8, 400 * 18 / 8)
    assert len({r.shard for r in got if r.doc_id % 4}) > 4


def test_small_groups_stay_together(spark):
    rows = [(i, f"text number {i // 3}", "en") for i in range(3000)]
    got = histogram_sort(documents(spark, rows), 8, 0.02).collect()
    homes = {}
    for r in got:
        homes.setdefault(r.doc_id // 3, set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_odd_rows_and_empty_table(spark):
    got = histogram_sort(documents(spark), 3, carry=True).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got}
    assert by_id[2]["size"] == ROW_BYTES and by_id[2].text_crc32 == 0 and by_id[2].row.size == 5
    assert {r.shard for r in got if r.doc_id == 3} == {by_id[3].shard}
    assert histogram_sort(documents(spark, []), 3).collect() == []
