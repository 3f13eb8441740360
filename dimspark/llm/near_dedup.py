"""Near-duplicate documents by SuperMinHash, banding and verification.

*Signature.* Every distinct shingle deals itself to the signature's
components by a random permutation of its own: at step j it offers its
j-th component the value j + u, u in [0, 1). A component keeps its least
offer. A value offered at step j is below every value of later steps, so a
component that has one by step j is final, and a text stops as soon as all
are: after two or three steps for a text of a few hundred shingles. The
offers of one element are correlated (it hits each component once), which
makes the estimate less noisy than with independent hashes.

*Candidates.* Texts with equal sets are one class, represented by the
least id. Signatures are cut into bands; representatives that agree in a
band share a bucket.

*Links.* Every member of a bucket is compared with the bucket's least
member, on full sets: one pair per member. Where that leaves a bucket in
more than one component, the buckets left are joined to families, a family
is dealt into blocks of at most ``block`` members, and pairs of blocks are
compared inside tasks (whole sets, all members); pairs inside the largest
component are skipped. No pair is given up, and a pair is a row only if it
is a link that joins two components.

*Groups.* Links are merged by union-find in tasks and star contraction
across them.

Defined results: a null or empty text has no shingles, links with nothing
and is its own component; a text of fewer words than a shingle counts as
one shingle, its whole word sequence; rows that share an id are one node,
linked by whatever any of its rows links; rows without an id are left
out; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.llm.chunks import discard, store
from dimspark.llm.components import UnionFind, components
from dimspark.llm.text import SPACED_LOWER, U64, Words, mix, pair_hash, scan, slices


ELEMENTS = 1 << 16  # elements whose permutations are held at a time


def shingle_sets(w: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h = w.hash
    n = max(len(h) - size + 1, 0)
    s = h[:n]
    for k in range(1, size):
        s = pair_hash(s, h[k : n + k])
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= size:
            x = np.sort(s[a : b - size + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif b > a:
            x = np.array([b - a], np.uint64)  # shorter texts never equal a full shingle
            for k in range(a, b):
                x = pair_hash(x, h[k : k + 1])
            out.append(x)
        else:
            out.append(h[:0])
    return out


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """Signatures, one row of m 64-bit values per set. Sets advance together,
    step by step, about ELEMENTS elements at a time; a set with more is cut
    into pieces, whose offers meet in its row."""
    sig = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    group, pieces, size = [], [], 0
    for i, s in enumerate(sets):
        for at in range(0, len(s), ELEMENTS):
            group.append(i)
            pieces.append(s[at : at + ELEMENTS])
            size += len(pieces[-1])
            if size >= ELEMENTS:
                _fill(sig, np.array(group), pieces, m)
                group, pieces, size = [], [], 0
    if group:
        _fill(sig, np.array(group), pieces, m)
    return sig


def _fill(sig: np.ndarray, rows: np.ndarray, sets: list[np.ndarray], m: int) -> None:
    element = np.concatenate(sets)
    row = np.repeat(rows, [len(s) for s in sets])
    flat = sig.reshape(-1)
    order = None
    for step in range(m):
        r = mix(element + U64((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        k = step + ((r & U64(0xFFFFFFFF)) * U64(m - step) >> U64(32)).astype(np.int64)
        if order is None:  # Fisher-Yates, one permutation per element
            order = np.broadcast_to(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(element), m)).copy()
        n = np.arange(len(element))
        to = order[n, k]
        order[n, k] = order[:, step]
        offer = (U64(step) << U64(32)) | (r >> U64(32))
        np.minimum.at(flat, row * m + to, offer)
        open_rows = (sig[rows] >> U64(32) > U64(step)).any(axis=1)  # a later step may still offer less
        if not open_rows.any():
            return
        if not open_rows.all():
            rows = rows[open_rows]
            left = np.isin(row, rows)
            element, row, order = element[left], row[left], order[left]


def _overlap_ok(both, a, b, percent: int):
    return 100 * both >= percent * (a + b - both)


def _sign(id_col: str, text_col: str, shingle: int, bands: int, rows: int):
    def sign(batches):
        for b in slices(batches, text_col, 1 << 20):
            sets = shingle_sets(scan(b.column(text_col), SPACED_LOWER), shingle)
            sig = superminhash(sets, bands * rows).reshape(len(sets), bands, rows)
            band = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sets), bands)).copy()
            for k in range(rows):
                band = pair_hash(band, sig[:, :, k])
            n = np.array([len(s) for s in sets], np.int64)
            one = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            two = np.array([np.bitwise_xor.reduce(mix(s + U64(7))) if len(s) else 0 for s in sets], np.uint64)
            flat = pa.array(band.view(np.int64).reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), flat)
            ids = b.column(id_col).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), lists],
                names=["id", "n", "one", "two", "bands"],
            )

    return sign


def _verify(shingle: int, percent: int):
    def verify(batches):
        for b in slices(batches, "text_b", 1 << 20):
            sa = shingle_sets(scan(b.column("text_a"), SPACED_LOWER), shingle)
            sb = shingle_sets(scan(b.column("text_b"), SPACED_LOWER), shingle)
            ok = [
                _overlap_ok(len(x) + len(y) - len(np.union1d(x, y)), len(x), len(y), percent) for x, y in zip(sa, sb)
            ]
            t = pa.table([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
            yield from t.to_batches()

    return verify


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices."""
    n = len(sets)
    out = np.zeros((n, n), np.float64)
    if not n:
        return out
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1
    shared = times[col] > 1
    owner, col = owner[shared], rank[col[shared]]
    by = np.argsort(col, kind="stable")
    owner, col = owner[by], col[by]
    step = 4096
    for at in range(0, int(col[-1]) + 1 if len(col) else 0, step):
        i, j = np.searchsorted(col, [at, at + step])
        inc = np.zeros((n, step), np.float32)
        inc[owner[i:j], col[i:j] - at] = 1
        out += inc @ inc.T
    return out


def _compare(shingle: int, percent: int):
    def compare(key, table):
        sets = shingle_sets(scan(table["text"], SPACED_LOWER), shingle)
        ids, label = table["id"].to_numpy(), table["label"].to_numpy()
        size = np.array([len(s) for s in sets])
        ok = _overlap_ok(_overlaps(sets), size[:, None], size[None, :], percent)
        ok &= label[:, None] != label[None, :]
        _, first, group = np.unique(label, return_index=True, return_inverse=True)
        found, merged = [], UnionFind(len(first))
        for i, j in zip(*np.nonzero(np.triu(ok, 1))):
            if merged.union(int(group[i]), int(group[j])):
                found.append((int(ids[i]), int(ids[j])))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return compare


def _blocks(left: DataFrame, block: int) -> DataFrame:
    """(id, label, family, lo, hi): the block pairs each member goes to.
    Members outside the family's largest component meet everyone; those
    inside it meet only the others."""
    label = left.groupBy("family", "label").agg(F.count("*").alias("n"))
    family = label.groupBy("family").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top")
    )
    size = family.select(
        "family",
        F.when(F.col("n") <= block, F.lit(None).cast("long")).otherwise(F.col("top.label")).alias("main"),
        F.when(F.col("n") <= block, 1).otherwise(F.ceil((F.col("n") - F.col("top.n")) / block)).cast("long").alias("q"),
        F.when(F.col("n") <= block, 0).otherwise(F.ceil(F.col("top.n") / block)).cast("long").alias("p"),
    )
    rows = left.join(size, "family")
    inside = F.col("label").eqNullSafe(F.col("main"))
    h = F.xxhash64("id")
    rows = rows.withColumn(
        "blk", F.when(inside, F.col("q") + F.pmod(h, F.greatest("p", F.lit(1)))).otherwise(F.pmod(h, F.greatest("q", F.lit(1))))
    )
    meets = F.when(inside, F.sequence(F.lit(0).cast("long"), F.col("q") - 1)).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("q") + F.col("p") - 1)
    )
    return rows.where("q > 0").select("id", "label", "family", "blk", F.explode(meets).alias("other")).select(
        "id", "label", "family", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = 32,
    rows: int = 4,
    block: int = 256,
) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id (least id that
    is reachable over links of Jaccard similarity >= percent/100) and kept
    (it is its own component's least id). bands x rows <= 65536."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    signed = store(
        spark,
        texts.mapInArrow(_sign("id", "text", shingle, bands, rows), "id long, n long, one long, two long, bands array<long>"),
        "signatures",
    )
    classes = store(
        spark,
        signed.where("n > 0").groupBy("n", "one", "two").agg(F.min("id").alias("rep"), F.any_value("bands").alias("bands")),
        "classes",
    )
    band = classes.select(F.explode("bands").alias("band"), F.col("rep").alias("id"))
    bucket = band.groupBy("band").agg(F.count("*").alias("c"), F.min("id").alias("hub")).where("c > 1").drop("c")
    member = store(spark, band.join(bucket, "band"), "buckets")

    text = store(spark, texts.join(member.select("id").distinct(), "id", "left_semi"), "candidates")
    star = member.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    pairs = star.join(text.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        text.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    links = store(spark, pairs.mapInArrow(_verify(shingle, percent), "a long, b long"), "links")
    label = components(links).withColumnRenamed("node", "id")

    # Buckets in which the comparison with the least member leaves more than one component.
    named = member.join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    split = named.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("band")
    left = split_members = store(spark, named.join(split, "band", "left_semi"), "split-buckets")
    families = components(left.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct())
    left = left.select("id", "label").distinct().join(
        families.select(F.col("node").alias("id"), F.col("label").alias("family")), "id"
    )
    meet = _blocks(left, block).join(text, "id")
    more = meet.groupBy("family", "lo", "hi").applyInArrow(_compare(shingle, percent), "a long, b long")

    final = components(links.unionByName(more))  # written: what only it needed can go
    discard(member, text, links, split_members)
    final = final.select(F.col("node").alias("rep"), F.col("label").alias("component"))
    of = classes.select("n", "one", "two", "rep").join(final, "rep", "left")
    out = signed.drop("bands").join(of, ["n", "one", "two"], "left")
    component = F.coalesce("component", "rep", "id")
    found = out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return found.withColumn("kept", F.col("id") == F.col("component_id")).withColumnRenamed("id", id_col)


ROW = "__dimspark_row"  # a name that no column of a user has


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with one row of each group of near duplicates: that of the
    least id, then of the least text hash. Every row is a node of its own,
    so rows that share an id and are not linked all stay. Rows without
    shingles are one if id and text are equal. Rows without an id are kept."""
    spark = docs.sparkSession
    some = docs.where(F.col(id_col).isNotNull()).withColumn(ROW, F.monotonically_increasing_id())
    some = store(spark, some, "numbered")  # the numbers must not change
    found = near_duplicates(some, id_col=ROW, text_col=text_col, **options).select(ROW, "n_shingles", "component_id")
    rest = F.xxhash64(*(f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind))  # of rows equal in id and text
    order = some.select(ROW, F.col(id_col).alias("id"), F.md5(F.col(text_col)).alias("text"), rest.alias("rest"))
    bare = F.col("n_shingles") == 0
    group = [F.when(~bare, F.col("component_id")), F.when(bare, F.col("id")), F.when(bare, F.col("text"))]
    least = found.join(order, ROW).groupBy(*group).agg(F.min(F.struct("id", "text", "rest", ROW)).alias("least"))
    one = some.join(least.select(f"least.{ROW}"), ROW, "left_semi").drop(ROW)
    return one.unionByName(docs.where(F.col(id_col).isNull()))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: components of documents whose 3-word shingle sets agree to 85 %."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, shingle=3, percent=85, bands=25, rows=5)
