"""Near-duplicate documents by one-permutation MinHash.

A document is the set of hashes of its word shingles.  One hash deals the shingles into bins
and the least hash of each bin is the signature; an empty bin takes the value of the first
filled one in an order of bins of its own (optimal densification), so that bins agree with
the probability of the sets' similarity also for short texts.  Bands of bins are the buckets.

Equal sets are one node.  In each bucket every node is paired with the least one only (a
star), so a bucket gives as many pairs as it has nodes.  Pairs are confirmed on the full sets:
first the likeliest of each node, then those that still join two components, and last,
exactly, what the stars leave out: nodes that share a bucket but no component.  Of these the
join itself leaves only pairs whose sizes and bitmaps allow a link; neither bound can rule out
a true one.  Links give components by alternating stars.

Chance of missing a link at the threshold: BANDS bands of ROWS bins each agree with
similarity ** ROWS; with 42 of 6 all fail with 2e-9 at 0.85 and 3e-6 at 0.8, less above.

Null and empty texts have no shingles and are linked with nothing.  A text of fewer words than
a shingle has its whole word sequence as one.  Rows that share an id are judged each by its
own text.  Rows with a null id are linked with nothing, their component is null and they are
kept.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epicentre.llm.common import coded_words, may_be_in, mix, slices, starts_of, string_hashes, written
from epicentre.llm.components import components

#: Fixed by the contract: words of a shingle and least similarity in percent.
SHINGLE, PERCENT = 3, 85
BANDS, ROWS = 42, 6
BINS = BANDS * ROWS
#: 64-bit words of a set's bitmap.
MAP_WORDS = 32
_MARK = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(text: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted in each text, and how many each text has."""
    codes, distinct, counts = coded_words(text, lower=True)
    h = string_hashes(distinct)[codes]
    first = starts_of(counts)
    acc = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    for j in range(k):
        acc = mix(acc + h[j : len(h) - k + 1 + j] + _MARK)
    n = np.maximum(counts - k + 1, 0)
    at = np.arange(int(n.sum())) + np.repeat(first - starts_of(n), n)
    doc, hashes = np.repeat(np.arange(len(counts)), n), acc[at]
    if len(short := np.flatnonzero((counts > 0) & (counts < k))):
        whole = np.full(len(short), np.uint64(k), np.uint64)
        for j in range(k - 1):
            more = counts[short] > j
            whole[more] = mix(whole[more] + h[first[short[more]] + j] + _MARK)
        doc, hashes = np.concatenate([doc, short]), np.concatenate([hashes, whole])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.bincount(doc[new], minlength=len(counts))


def _probes() -> np.ndarray:
    """For each bin, all bins in an order of its own: row t holds each bin's t-th choice."""
    x = np.arange(BINS * BINS, dtype=np.uint64).reshape(BINS, BINS)
    return np.argsort(mix(x + _MARK), axis=1).T.copy()


_PROBES = _probes()


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The densified signature of each set; zeros for an empty one."""
    rows = len(sizes)
    doc = np.repeat(np.arange(rows), sizes)
    place = mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    sig = np.full(rows * BINS, none)
    np.minimum.at(sig, doc * BINS + (place % np.uint64(BINS)).astype(np.int64), mix(place + _MARK))
    sig = sig.reshape(rows, BINS)
    sig[sizes == 0] = 0
    filled = sig != none
    row, col = np.nonzero(~filled)
    for choice in _PROBES:
        if not len(row):
            break
        source = choice[col]
        ok = filled[row, source]
        sig[row[ok], col[ok]] = sig[row[ok], source[ok]]
        row, col = row[~ok], col[~ok]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One bucket key for each band."""
    s = sig.reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _MARK, s.shape[:2])
    for j in range(ROWS):
        key = mix(key + s[:, :, j] + _MARK)
    return key


def bitmaps(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each set as bits: two maps differ in no more bits than the sets in elements."""
    out = np.zeros((len(sizes), MAP_WORDS), np.uint64)
    place = mix(hashes + np.uint64(3)) % np.uint64(64 * MAP_WORDS)
    np.bitwise_or.at(out, (np.repeat(np.arange(len(sizes)), sizes), (place >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (place & np.uint64(63)))
    return out


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values.view(np.int64)))


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashes, sizes = shingle_sets(part.column("text"), k)
            bands = band_keys(signatures(hashes, sizes))
            some = sizes > 0
            keys = []
            for salt in (1, 2):
                total = np.zeros(len(sizes), np.uint64)
                if some.any():
                    total[some] = np.add.reduceat(mix(hashes + np.uint64(salt)), starts_of(sizes)[some])
                keys.append(pa.array(total.view(np.int64), mask=~some))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes.astype(np.int64)), *keys, _lists(bands.reshape(-1), np.full(len(sizes), BANDS))],
                names=["doc_id", "n_shingles", "key1", "key2", "bands"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashes, sizes = shingle_sets(part.column("text"), k)
            bits = _lists(bitmaps(hashes, sizes).reshape(-1), np.full(len(sizes), MAP_WORDS))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(hashes, sizes), bits], names=["id", "shingles", "bits"])

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough."""
    a = sets.select(F.col("id").alias("u"), F.col("shingles").alias("s"))
    b = sets.select(F.col("id").alias("v"), F.col("shingles").alias("t"))
    both = F.size(F.array_intersect("s", "t"))
    d = pairs.select("u", "v").join(a, "u").join(b, "v").select("u", "v", both.alias("both"), (F.size("s") + F.size("t")).alias("n"))
    return d.where(100 * F.col("both") >= percent * (F.col("n") - F.col("both"))).select("u", "v").distinct()


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (u, v) whose nodes aren't in the same component yet."""
    of = lambda x: comps.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    d = pairs.join(of("u"), "u", "left").join(of("v"), "v", "left")
    return d.where(F.coalesce("cu", "u") != F.coalesce("cv", "v")).select("u", "v")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = d.mapInArrow(_sketch(k), "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>")
    sketches = written(sketches, "minhash-sketches")
    slim = sketches.drop("bands")

    # equal sets are one node, named by the least id
    real = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    classes = written(sketches.where(real).groupBy("key1", "key2").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n"), F.first("bands").alias("bands")), "minhash-classes")
    dealt = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = dealt.groupBy("bucket").agg(F.min("node").alias("center"), F.max("node").alias("last")).where("center < last").drop("last")
    members = written(dealt.join(shared, "bucket"), "minhash-members")
    stars = written(members.where("node != center").groupBy(F.col("center").alias("u"), F.col("node").alias("v")).agg(F.count("*").alias("bands")), "minhash-stars")

    needed = written(members.select(F.col("node").alias("doc_id")).distinct(), "minhash-needed")
    near = may_be_in(d, "doc_id", needed, "near").where("near").drop("near")  # most texts share no bucket
    sets = written(near.join(needed, "doc_id", "left_semi").mapInArrow(_sets(k), "id long, shingles array<long>, bits array<long>"), "minhash-sets")

    likely = stars.groupBy("v").agg(F.max(F.struct("bands", (-F.col("u")).alias("u"))).alias("b")).select((-F.col("b.u")).alias("u"), "v")
    links = written(_confirmed(likely, sets, percent), "minhash-links1")
    comps = written(components(links), "minhash-components1")
    links = written(links.unionByName(_confirmed(_apart(stars.join(likely, ["u", "v"], "left_anti"), comps), sets, percent)), "minhash-links2")
    comps = written(components(links), "minhash-components2")

    # what the stars leave out: nodes of one bucket in different components
    placed = members.join(comps, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("component"))
    torn = placed.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("bucket")
    placed = written(placed.join(torn, "bucket").join(sets.select(F.col("id").alias("node"), "bits"), "node"), "minhash-torn")
    x = placed.select("bucket", F.col("node").alias("u"), F.col("n").alias("nu"), F.col("component").alias("cu"), F.col("bits").alias("bu"))
    y = placed.select("bucket", F.col("node").alias("v"), F.col("n").alias("nv"), F.col("component").alias("cv"), F.col("bits").alias("bv"))
    # similar sets differ in at most (100 - percent) / (100 + percent) of their summed sizes
    differ = F.aggregate(F.zip_with("bu", "bv", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    may_link = F.when(100 * F.least("nu", "nv") < percent * F.greatest("nu", "nv"), F.lit(False)).otherwise((100 + percent) * differ <= (100 - percent) * (F.col("nu") + F.col("nv")))
    left = x.join(y, (x["bucket"] == y["bucket"]) & (F.col("cu") < F.col("cv")) & may_link)
    left = left.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    left = left.join(stars, ["u", "v"], "left_anti")
    more = written(_confirmed(left, sets, percent), "minhash-links3")

    if not more.isEmpty():
        comps = written(components(links.unionByName(more)), "minhash-components3")
    named = slim.join(classes.select("key1", "key2", "node"), ["key1", "key2"], "left").join(comps, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), F.when(real, component).otherwise(F.col("doc_id")))
    return named.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept, of repeated rows with one id a single one."""
    found = written(near_duplicates(docs, k, percent), "minhash-found")
    dropped = found.where(~F.col("kept")).select("doc_id").distinct()
    twice = found.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    rest = docs.join(written(dropped, "minhash-dropped"), "doc_id", "left_anti").select(*docs.columns)
    twice = written(twice, "minhash-repeated")
    if twice.isEmpty():
        return rest
    again = rest.join(twice, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return rest.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(again)


def linked_documents(docs: DataFrame) -> DataFrame:
    """op4: three-word shingles, a similarity of 0.85 or more."""
    return near_duplicates(docs)


LINKED_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 2], ' ') END AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""
