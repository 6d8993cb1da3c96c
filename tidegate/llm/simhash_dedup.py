"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; a bit is 1 if it is set in over half of the hashes of the text's
3-word shingles. Fingerprints at ``RADIUS`` = 2 or fewer differing bits are linked.

Index: the fingerprint is cut into ``SEGMENTS`` = 2 halves, and the table of a half holds every
distinct fingerprint under the bits of that half. Of 2 differing bits at most one lies in one of
the halves, so each fingerprint enumerates the Hamming ball of radius 1 of each half and fetches
what the table holds there; complete distances are verified in the join. A difference of one bit
is enumerated from the side where the bit is 0 only, which halves the ball.

A family of edited copies may share a half, and such a bucket would have to be compared pair by
pair. Buckets of over ``BUCKET`` fingerprints are left out of the table. All fingerprints that are
in one or would fetch it take part in a second search instead, keyed by the whole fingerprint with
up to one bit flipped: two of them within 2 bits share a key, a key has 65 fingerprints at most,
all within 2 bits of each other, and one link from each to the smallest keeps the component. So
no link is lost, and the rows of either search are linear in the fingerprints.

Defined results: null, empty and blank texts have fingerprint zero and are linked like any other;
a null id takes part, and a component of null ids only has a null id; repeated rows come out as
often as they came in; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import body, id_and_text, ship
from tidegate.llm.components import components
from tidegate.session import broadcast_if_small, stored

ship(__name__)

SHINGLE = 3
SEED = 42
RADIUS = 2
SEGMENTS = 2
WIDTH = 64 // SEGMENTS
#: Most fingerprints of a bucket that is compared with what fetches it.
BUCKET = 64


def fingerprint(text: str) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    return fingerprint_of(text.encode("utf-8", "surrogatepass"))


def fingerprint_of(data: bytes) -> int:
    """The fingerprint of a text given as UTF-8."""
    words = data.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        runs = zip(words, words[1:], words[2:], strict=False)
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(r), SEED) for r in runs),
                             np.uint64, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):     # memory of a long text
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    values = np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts))
    return pd.Series(values.view(np.int64))


def with_fingerprint(df: DataFrame) -> DataFrame:
    """Adds ``fp``, the fingerprint as a signed long, to rows with a ``text``."""
    compute = F.pandas_udf(_fingerprints, "long")
    return df.withColumn("fp", compute(body()))


def _keys(ball: bool) -> Column:
    """The key of each segment of ``fp``, or the keys of its ball: the key itself and the key with
    one more bit set."""
    keys = []
    for segment in range(SEGMENTS):
        own = (F.shiftrightunsigned("fp", segment * WIDTH)
               .bitwiseAND(F.lit((1 << WIDTH) - 1).cast("long"))
               .bitwiseOR(F.lit(segment << WIDTH).cast("long")))
        keys.append(own)
        for bit in [F.lit(1 << b).cast("long") for b in range(WIDTH if ball else 0)]:
            keys.append(F.when(own.bitwiseAND(bit) == 0, own.bitwiseOR(bit)))
    return F.array(*keys)


def _near(a: str, b: str) -> Column:
    return (F.col(a) != F.col(b)) & (F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= RADIUS)


def _dense_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) of fingerprints that crowd a bucket, by keys of whole fingerprints."""
    one = F.lit(1).cast("long")
    ball = F.array("fp", *[F.col("fp").bitwiseXOR(F.shiftleft(one, bit)) for bit in range(64)])
    near = (fps.select("fp", F.explode(ball).alias("entry"))
            .groupBy("entry").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1))
    return (near.select(F.array_min("fps").alias("b"), F.explode("fps").alias("a"))
            .where(_near("a", "b")).select("a", "b"))


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints of the column ``fp`` within RADIUS bits of another.

    Those of crowded buckets are stars, not all pairs: the components are those of all pairs.
    """
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One row becomes some 35. Dealt by fp again, the exchange would be merged into that of distinct.
    fps = fps.select("fp").distinct().repartition(parts)
    index = fps.select(F.explode(_keys(ball=False)).alias("key"), "fp")
    probes = (fps.select(F.explode(_keys(ball=True)).alias("key"), "fp")
              .where("key is not null"))
    crowded = broadcast_if_small(stored(
        index.groupBy("key").count().where(F.col("count") > BUCKET).select("key"), "crowded"))
    fetched = (probes.withColumnRenamed("fp", "a")
               .join(index.join(crowded, "key", "left_anti").withColumnRenamed("fp", "b"), "key")
               .where(_near("a", "b")).select("a", "b"))
    # The key of a fingerprint's own bucket is one of its probes.
    dense = stored(probes.join(crowded, "key", "left_semi").select("fp").distinct(), "dense")
    return fetched.union(_dense_links(dense.repartition(parts, "fp"))).distinct()


def groups(rows: DataFrame) -> DataFrame:
    """fp, the root of its component and component_id, for every distinct fingerprint of rows
    with ``doc_id`` and ``fp``."""
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes))
    rooted = classes.join(roots.select(F.col("u").alias("fp"), "v"), "fp", "left").select(
        "fp", "first", F.coalesce("v", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id, the smallest id that links reach, for every row."""
    rows = stored(with_fingerprint(id_and_text(df, id_col, text_col)).select("doc_id", "fp"),
                  "fingerprints")
    return rows.join(groups(rows), "fp").select("doc_id", "fp", "component_id")
