"""Near-duplicate documents by an inverted join of MinHash signature coordinates.

Documents with equal shingle sets collapse into one representative. Its signature
has K coordinates; it is posted under each (coordinate, value) pair. Two sets of
similarity 0.75 agree in all but a 10^-7 part of cases in at least MATCHES
coordinates. Postings are ordered from rare to common; of a signature only the
first K - MATCHES + 1 need merging (two signatures with enough matches share one
of them), and pairs that one document alone has fill the first places, so most
documents and all common passages are skipped. Candidates then have all their
collisions counted, and those above the threshold are confirmed on full sets.

Large groups never become all their pairs: first every posting list is linked
with its most central member, confirmed links are contracted into components, and
only members around a centre that still form several components are compared in
full, block by block, each block returning a spanning forest of its links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.functions.joins import left_join_split
from clinlake.llm.common import map_rows, saved, words_of
from clinlake.llm.components import components

K = 64
MATCHES = 29
WIDTH = 5
SIMILAR = 75  # percent
#: Members of a group that are compared with as many others in one task.
BLOCK = 512
#: Bits of the filter that tells which documents' full sets are needed; 2 MB whatever the corpus.
FILTER_BITS = 2**24

_mix = np.random.default_rng(20240229)
_A = (_mix.integers(0, 2**32, K, dtype=np.uint64).astype(np.uint32)) | np.uint32(1)
_B = _mix.integers(0, 2**32, K, dtype=np.uint64).astype(np.uint32)
_C = (_mix.integers(0, 2**63, WIDTH, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; a shorter text is one shingle."""
    words = words_of(text) if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    n = max(1, len(h) - width + 1)
    s = np.full(n, np.uint64(min(len(h), width)), dtype=np.uint64)
    for k in range(min(width, len(h))):
        s += (h[k : k + n] ^ (h[k : k + n] >> np.uint64(29))) * _C[k]
    return np.unique(s ^ (s >> np.uint64(31)))


def signature(s: np.ndarray) -> list[int]:
    """The smallest value of each of K hash functions over a shingle set, as signed 32-bit integers."""
    x = (s >> np.uint64(20)).astype(np.uint32)
    best = np.full(K, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(x), 2048):
        best = np.minimum(best, (x[at : at + 2048, None] * _A + _B).min(axis=0))
    return best.view(np.int32).tolist()


def digest(s: np.ndarray) -> list[int]:
    """128 bits that stand for a shingle set."""
    return np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64).tolist()


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, sig): set size, 128-bit digest of the set, and signature."""

    def start():
        def work(rows):
            out = []
            for r in rows:
                s = shingles(r["text"])
                if not len(s):
                    out.append((r["doc_id"], 0, None, None, None))
                    continue
                out.append((r["doc_id"], len(s), *digest(s), signature(s)))
            return out

        return work

    return map_rows(
        docs.select("doc_id", "text"), "doc_id long, n_shingles long, d1 long, d2 long, sig array<int>", start
    )


def _postings(reps: DataFrame) -> DataFrame:
    """(token, rep, central) for the prefix of each signature: its rarest shared coordinate-value pairs.

    ``central`` is higher the more documents have the signature's values: of a group
    of edited copies, the text that they are copies of has the highest.
    """
    tokens = reps.select("rep", F.posexplode("sig").alias("place", "value")).select(
        "rep", ((F.col("place").cast("long") * F.lit(2**32)) + F.col("value").cast("long")).alias("token")
    )
    shared = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    prefix = (
        tokens.join(shared, "token")
        .groupBy("rep")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("own"))
        .where(F.size("own") >= MATCHES)
        .withColumn("central", F.aggregate("own", F.lit(0).cast("long"), lambda acc, x: acc + x["n"]))
        .select("rep", "central", F.explode(F.slice("own", F.lit(1), F.size("own") - MATCHES + 1)).alias("t"))
    )
    return prefix.select(F.col("t.token").alias("token"), "rep", "central")


def _matching(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose signatures collide in enough coordinates."""
    a = reps.select(F.col("rep").alias("a"), F.col("sig").alias("sa"))
    b = reps.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))
    same = F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int"))
    hits = F.aggregate(same, F.lit(0), lambda acc, x: acc + x)
    return pairs.join(a, "a").join(b, "b").where(hits >= MATCHES).select("a", "b")


def _full_sets(spark, docs: DataFrame, wanted_reps: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, s): the full shingle sets of these representatives.

    The ids of documents that have them travel to the texts as a filter of fixed size, so
    texts are not shuffled; sets that the filter lets through without need are joined with nothing.
    """
    page = 32_768  # bits of Spark's own bitmaps
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    marks = (
        reps.join(wanted_reps, "rep", "left_semi")
        .select(slot.alias("slot"))
        .groupBy(F.expr(f"slot div {page}").alias("page"))
        .agg(F.bitmap_construct_agg(F.col("slot") % page).alias("bits"))
        .collect()
    )
    wanted = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in marks:
        wanted[r["page"] * page // 8 : (r["page"] + 1) * page // 8] = np.frombuffer(r["bits"], dtype=np.uint8)

    def start():
        def work(rows):
            found = (
                shingles(r["text"]) for r in rows if r["text"] and wanted[r["slot"] >> 3] >> (r["slot"] & 7) & 1
            )
            return [(*digest(s), s.view(np.int64)) for s in found if len(s)]

        return work

    known = docs.where("doc_id is not null").select("text", slot.alias("slot"))
    found = saved(spark, map_rows(known, "d1 long, d2 long, s array<long>", start), "sets")
    # Of equal sets one is enough; a set is told by its digest, as an id may have several texts.
    return found.groupBy("d1", "d2").agg(F.min("s").alias("s")).join(reps, ["d1", "d2"]).select("rep", "s")


def _same_ids(base: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (a, b) between the representatives of rows that repeat a doc_id with other texts."""
    one = F.struct("d1", "d2")
    several = base.groupBy("doc_id").agg(F.min(one).alias("least"), F.max(one).alias("most")).where("least <> most")
    rows = left_join_split(base.select("doc_id", "d1", "d2"), several.select("doc_id", "least"), "doc_id")
    pairs = rows.where("least is not null").select("d1", "d2", "least.d1", "least.d2").toDF("d1", "d2", "l1", "l2").distinct()
    ends = reps.select(F.col("d1").alias("l1"), F.col("d2").alias("l2"), F.col("rep").alias("b"))
    return pairs.join(reps.select("d1", "d2", F.col("rep").alias("a")), ["d1", "d2"]).join(ends, ["l1", "l2"]).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with 100 * intersection >= 75 * union on their full shingle sets."""
    a = sets.select(F.col("rep").alias("a"), F.col("s").alias("sa"))
    b = sets.select(F.col("rep").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return pairs.join(a, "a").join(b, "b").where(100 * both >= SIMILAR * union).select("a", "b")


def _incidence(sets: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Which set has which of these sorted shingles, as a matrix of 0 and 1."""
    out = np.zeros((len(sets), len(columns)), dtype=np.float32)
    for i, s in enumerate(sets):
        at = np.searchsorted(columns, s)
        at[at == len(columns)] = 0
        out[i, at[columns[at] == s]] = 1
    return out


def forest(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
    """Links between members (rep, root, s) of two blocks that join different roots, as a spanning forest."""
    pairs: list[tuple[int, int]] = []
    if len(x) and len(y):
        sx, sy = ([np.asarray(s, dtype=np.int64) for s in side["s"]] for side in (x, y))
        shared = np.intersect1d(np.unique(np.concatenate(sx)), np.unique(np.concatenate(sy)))
        both = np.zeros((len(sx), len(sy)), dtype=np.float32)
        for at in range(0, len(shared), 8192):
            both += _incidence(sx, shared[at : at + 8192]) @ _incidence(sy, shared[at : at + 8192]).T
        both = both.astype(np.int64)
        union = np.array([len(s) for s in sx])[:, None] + np.array([len(s) for s in sy])[None, :] - both
        rx, ry = x["root"].to_numpy(np.int64), y["root"].to_numpy(np.int64)
        linked = (100 * both >= SIMILAR * union) & (rx[:, None] != ry[None, :])
        parent: dict[int, int] = {}

        def top(v):
            while parent.setdefault(v, v) != v:
                parent[v] = v = parent[parent[v]]
            return v

        for i, j in zip(*np.nonzero(linked), strict=True):
            a, b = top(int(rx[i])), top(int(ry[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                pairs.append((int(x["rep"].iloc[i]), int(y["rep"].iloc[j])))
    return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def _late_links(stars: DataFrame, root: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the components that members around one hub still form."""
    around = stars.select("hub", "rep").unionAll(stars.select("hub", F.col("hub").alias("rep")).distinct())
    placed = around.join(root, F.col("rep") == F.col("id"), "left").select(
        "hub", "rep", F.coalesce("root", "rep").alias("root")
    )
    open_hubs = (
        placed.groupBy("hub", "root")
        .agg(F.count("*").alias("n"))
        .groupBy("hub")
        .agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max_by("root", F.struct("n", "root")).alias("main"))
        .where("parts > 1")
        .select("hub", "main", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    )
    members = placed.join(open_hubs, "hub").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    members = members.join(sets, "rep")
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    same = [F.col(c).alias(c) for c in ("hub", "rep", "root", "s")]  # new columns, so that both sides can meet
    x = members.where("root <> main").select(F.col("own").alias("i"), others.alias("j"), *same)
    y = members.select(others.alias("i"), F.col("own").alias("j"), *same)
    return x.groupBy("hub", "i", "j").cogroup(y.groupBy("hub", "i", "j")).applyInPandas(forest, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Components of near-duplicates: (doc_id, n_shingles, component_id, kept).

    Documents are linked when their sets of 5-word shingles have a similarity of
    0.75 or more; the component's id is its smallest doc_id, which is the one kept.
    NULL texts and texts without words have no shingles and are linked with nothing,
    and so are rows without doc_id (component NULL, kept). A repeated doc_id gives
    one row per row: such rows are one document, linked with whatever any of their texts is
    near to. Other columns are ignored; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    base = saved(spark, signatures(docs), "signatures")
    known = base.where("doc_id is not null and n_shingles > 0")
    # One representative for every set, whichever ids its documents have.
    reps = saved(
        spark,
        known.groupBy("d1", "d2").agg(F.min_by("sig", "doc_id").alias("sig"), F.min("doc_id").alias("doc_id"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "representatives",
    )
    posts = saved(spark, _postings(reps), "postings")
    hubs = posts.groupBy("token").agg(F.max(F.struct("central", -F.col("rep"))).alias("h"), F.count("*").alias("n"))
    hubs = hubs.where("n > 1").select("token", (-F.col("h.col2")).alias("hub"))
    stars = posts.join(hubs, "token").select("rep", "hub").where("rep <> hub")
    stars = saved(spark, stars.distinct(), "stars")
    met = stars.select(F.col("hub").alias("rep")).unionAll(stars.select("rep")).distinct()
    sets = _full_sets(spark, docs, met, reps)
    pairs = stars.select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    links = saved(spark, _confirmed(_matching(pairs, reps), sets), "links")
    late = _late_links(stars, components(spark, links), sets)
    root = components(spark, links.unionAll(late).unionAll(_same_ids(known, reps)))

    # Every document has its set's representative, and with it the component.
    own = reps.join(root, F.col("rep") == F.col("id"), "left").select(
        "d1", "d2", "doc_id", F.coalesce("root", "rep").alias("root")
    )
    least = own.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = left_join_split(own.select("d1", "d2", "root"), least, "root").select("d1", "d2", "component_id")
    return (
        base.drop("sig")
        .join(named, ["d1", "d2"], "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
            F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
        )
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents, one of each near-duplicate group: the row with the smallest doc_id.

    Of rows that repeat a doc_id one stays; rows without doc_id all stay.
    """
    found = near_duplicates(docs)
    found = saved(docs.sparkSession, found.select("doc_id", "kept"), "kept")
    ids = found.where("doc_id is not null").groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("n"))
    left = docs.join(ids.where("not kept").select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    if ids.where("n > 1").isEmpty():
        return left
    once = left.where("doc_id is not null").dropDuplicates(["doc_id"])
    return once.unionByName(left.where("doc_id is null"))


#: The same result in DuckDB, by counting the shingles that every two documents share.
ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END) AS s
  FROM texts
), members AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM members a JOIN members b USING (g)
  WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common.n >= 75 * (p.n + q.n - common.n)
), sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM sizes UNION SELECT r.doc_id, s.y FROM reached r JOIN sides s ON s.x = r.other
), named AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN named USING (doc_id)
"""
