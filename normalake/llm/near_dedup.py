"""Near-dedup by min-max hashing with exact confirmation.

Method: a document's set is its distinct 5-word shingles (64-bit hashes).
PERMUTATIONS hash functions give a minimum and a maximum each, so BANDS bands
of ROWS values need half as many evaluations as plain MinHash.  At a Jaccard
similarity of 0.75 a pair misses all 64 bands of 6 values with a probability of
4e-6, at 0.8 with 4e-9, if the sets are large; as minimum and maximum of small
sets depend on each other, it is 1.9e-4 for 3 of 4 shingles, 2.3e-5 for 6 of 8
and 1.2e-5 for 9 of 12.  Every link is then confirmed on the full sets.

Equal sets are one class from the start; classes meet in buckets (band, key).
In a bucket the smallest class is the hub and meets all others: linear in the
bucket.  Each class is compared with the hub it meets most often, and with its
other hubs only where that leaves a bucket in several components.  Sets whose
sizes rule a link out are not compared.  What remains are pairs of members in
different components of a bucket.  Only shingles that several components have
count for these, as only such can be in a new link's intersection.  Pairs that
share a rare one (in up to RARE open documents) are found by it.  All others
meet in frequent shingles alone: a member with too few of them for the bucket's
smallest set goes, and members outside a bucket's largest component meet those
members whose set sizes their frequent shingles allow.  No bound loses a link.  Components are found by
star contraction.  The sets of documents that meet another are made once and
kept as Parquet in the shared folder; tables that no later step reads go.
No step gathers a bucket, group or component in one task or on the driver.

Defined cases: fewer than 5 words: the whole sequence is one shingle; no words,
or null text: an empty set, linked with nothing.  Rows of one doc_id are one
document and share a component.  A null doc_id is linked with nothing: its
component_id is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from normalake.llm._components import components
from normalake.llm._skew import attached, per_salt, salt, salts_seen
from normalake.llm._text import grams, hashed_words, joined, mix, small_batches, word_ranges
from normalake.sources.tables import dropped, stored

WORDS, BANDS, ROWS = 5, 64, 6
PERMUTATIONS = BANDS * ROWS // 2
RARE = 16
#: Members of a key that meet each other in one task.
TOGETHER = 4096
#: Set sizes that differ by less than a tenth are mostly in one cell.
CELLS = 10
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75


def shingle_sets(texts: pa.Array, n: int = WORDS) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    data, at = joined(texts)
    starts, _, h = hashed_words(data, "nonspace")
    first, g = word_ranges(starts, at), grams(h, n)
    out = []
    for lo, hi in zip(first[:-1], first[1:]):
        if hi - lo >= n:
            out.append(np.unique(g[lo : hi - n + 1]))
        elif hi > lo:
            out.append(mix(grams(h[lo:hi], int(hi - lo)) + np.uint64(hi - lo)))
        else:
            out.append(g[:0])
    return out


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(31337))
    a = rng.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a[:, None], rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)[:, None]


def signature(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum and maximum under each permutation: (PERMUTATIONS, 2)."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for lo in range(0, len(x), 2048):
        h = x[None, lo : lo + 2048] * a
        h += b
        np.minimum(low, h.min(1), out=low)
        np.maximum(high, h.max(1), out=high)
    return np.stack((low, high), 1)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(texts, PERMUTATIONS, 2) -> (texts, BANDS) 64-bit keys."""
    values = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), values.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, :, r])
    return key.view(np.int64)


def _identify(batch: pa.RecordBatch, sets: list[np.ndarray]) -> dict[str, pa.Array]:
    """doc_id, set size, and 128 bits that name the set."""
    c1 = np.array([mix(x * np.uint64(3)).sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
    c2 = np.array([mix(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
    return {"doc_id": batch.column("doc_id"), "n": pa.array([len(x) for x in sets], pa.int64()), "c1": pa.array(c1), "c2": pa.array(c2)}


_NAMED = "doc_id long, n long, c1 long, c2 long"


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        columns = _identify(batch, shingle_sets(batch.column("text")))
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = _permutations()
    for batch in small_batches(batches, "text"):
        sets = shingle_sets(batch.column("text"))
        some = [x for x in sets if len(x)]
        keys = band_keys(np.stack([signature(x, a, b) for x in some])) if some else np.zeros((0, BANDS), np.int64)
        offsets = np.zeros(len(sets) + 1, np.int32)
        np.cumsum([BANDS * (len(x) > 0) for x in sets], out=offsets[1:])
        columns = _identify(batch, sets) | {"bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _list_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        sets = shingle_sets(batch.column("text"))
        offsets = np.zeros(len(sets) + 1, np.int32)
        np.cumsum([len(x) for x in sets], out=offsets[1:])
        values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        columns = {"id": batch.column("doc_id"), "n": pa.array(np.diff(offsets).astype(np.int64)), "shingles": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The shingles of the documents with these ids (doc_id): id, n, shingles."""
    # the ids are the small side, and texts are not sorted for this join
    texts = docs.join(ids.hint("shuffle_hash"), "doc_id", "left_semi")
    return texts.mapInArrow(_list_sets, "id long, n long, shingles array<long>")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that are links by their full sets."""
    pairs = stored(pairs.select("u", "v").distinct())
    others = pairs.join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("other")), "v")
    met = attached(others, "u", "v", sets.select(F.col("id").alias("u"), F.col("shingles").alias("one"))).select("u", "v", F.size(F.array_intersect("one", "other")).alias("common"), (F.size("one") + F.size("other")).alias("both"))
    found = stored(met.where(f"100 * common >= {PERCENT} * (both - common)").select("u", "v"))
    dropped(pairs)
    return found


def _rooted(rows: DataFrame, roots: DataFrame, of: str, to: str) -> DataFrame:
    """rows with the component's root of column ``of`` as column ``to``."""
    found = rows.join(roots.select(F.col("node").alias(of), F.col("root").alias(to)), of, "left")
    return found.withColumn(to, F.coalesce(to, of))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v) of different components, with their roots a and b."""
    of_u = roots.select(F.col("node").alias("u"), F.col("root").alias("a"))
    found = _rooted(attached(pairs, "u", "v", of_u, "left"), roots, "v", "b")
    return found.withColumn("a", F.coalesce("a", "u")).where("a != b")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (node, root) after more links (u, v): only the components that
    these meet are joined up anew."""
    if not links.take(1):
        dropped(links)
        return roots
    new = components(_apart(links, roots).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    moved = roots.join(new.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    out = stored(moved.union(new))
    dropped(roots, links, new)
    return out


def _hubs(members: DataFrame) -> DataFrame:
    """members (key, id, n) -> key, hub, id, size: the members of each key with
    two or more, but for its hub, the smallest id; many: three or more."""
    members = members.withColumn("s", salt("id"))
    keys = members.groupBy("key").agg(F.min("id").alias("hub"), F.min_by("n", "id").alias("hub_n"), F.count("*").alias("many"), salts_seen("s").alias("seen")).where("many > 1")
    keys = keys.select("key", "hub", "hub_n", (F.col("many") > 2).alias("many"), "seen")
    return members.join(per_salt(keys, "seen", "s").hint("shuffle_hash"), ["key", "s"]).where("id != hub").select("key", "hub", "id", "many", F.expr(f"100 * least(n, hub_n) >= {PERCENT} * greatest(n, hub_n)").alias("may"))


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """members (key, id) of the keys whose members are in several components,
    with their component's root and whether that is not the key's largest
    (apart)."""
    own = _rooted(members.select("key", "id"), roots, "id", "root").withColumn("s", salt("id"))
    each = own.groupBy("key", "root").agg(F.count("*").alias("m"), salts_seen("s").alias("seen"))
    keys = each.groupBy("key").agg(F.count("*").alias("roots"), F.max(F.struct("m", "root")).alias("most"), F.bit_or("seen").alias("seen")).where("roots > 1")
    keys = keys.select("key", "seen", F.col("most.root").alias("main"))
    return own.join(per_salt(keys, "seen", "s").hint("shuffle_hash"), ["key", "s"]).select("key", "id", "root", F.expr("root != main").alias("apart"))


def _sides(members: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    one, other = (members.select(*names, *(F.col(k).alias(f"{k}_{e}") for k in members.columns if k not in names)) for e in "uv")
    return one, other


_PAIR = ["least(id_u, id_v) AS u", "greatest(id_u, id_v) AS v"]


def _apart_with_all(members: DataFrame) -> DataFrame:
    """Pairs (u, v) of members (key, id, root, apart, ...) in different
    components of a key whose sizes allow each other: of such two, at least one
    is outside the key's largest component (apart). A key of more than TOGETHER
    members is dealt to as many tasks as it needs, 64 at most, and those apart
    go to each, so a key of any size loads no single task and one of usual size
    is not copied; sizes meet by cells, of which a member has about 6. Two that
    share several of their keys (a key for each band at most) meet in the least
    of these alone."""
    members = members.select("key", "id", "root", "apart", "n", "big", "low", "high", "keys")
    tasks = members.groupBy("key").agg(F.expr(f"CAST(least(64, pow(2, ceil(log2(greatest(1, count(*) / {TOGETHER}))))) AS INT)").alias("tasks"))
    members = attached(members, "key", "id", tasks).withColumn("s", F.col("tasks") - 1)
    one, other = _sides(members.drop("tasks"), "key", "s")
    other = other.withColumn("s", salt("id_v").bitwiseAND(F.col("s")))
    one = one.where("apart_u").withColumn("s", F.explode(F.expr("sequence(0, s)")))
    cell = lambda n: f"CAST(floor(ln({n}) * {CELLS}) AS INT)"
    one = one.withColumn("cell", F.explode(F.expr(f"sequence({cell('low_u')}, {cell('high_u')})")))
    other = other.withColumn("cell", F.explode(F.expr(f"sequence({cell('n_v')}, {cell('big_v')})")))
    met = other.join(one, ["key", "s", "cell"])
    first = "key = array_min(array_intersect(keys_u, keys_v))"
    allowed = "n_u <= high_v AND big_u >= low_v AND n_v <= high_u AND big_v >= low_u"
    # both apart: once
    return met.where(f"root_u != root_v AND (NOT apart_v OR id_u < id_v) AND {allowed} AND {first}").selectExpr(*_PAIR)


def _shared(members: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """members (key, id, root, ...) -> ids with their set's size (least, most:
    n, big, as an id may have several texts) and q, how many of its frequent
    shingles other components have too; and the pairs that share rare shingles
    and may be linked."""
    listed = members.select("id", "root").distinct().join(sets, "id").select("id", "root", "n", F.explode("shingles").alias("shingle"))
    listed = listed.withColumn("s", salt("id"))
    often = listed.groupBy("shingle").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("often"), salts_seen("s").alias("seen")).where("a != b").select("shingle", "often", "seen")
    found = stored(listed.join(per_salt(often, "seen", "s").hint("shuffle_hash"), ["shingle", "s"]).drop("s"))
    sizes = found.groupBy("id", "n").agg(F.count(F.expr(f"CASE WHEN often > {RARE} THEN 1 END")).alias("q"))
    sizes = stored(sizes.groupBy("id").agg(F.min("n").alias("n"), F.max("n").alias("big"), F.max("q").alias("q")))
    one, other = _sides(found.where(f"often <= {RARE}").select("shingle", "id", "root").distinct(), "shingle")
    pairs = one.join(other, "shingle").where("id_u < id_v AND root_u != root_v").groupBy("id_u", "id_v").agg(F.count("*").alias("rare"))
    one, other = _sides(sizes)
    pairs = pairs.join(one, "id_u").join(other, "id_v").where(f"{100 + PERCENT} * (rare + least(q_u, q_v)) >= {PERCENT} * (n_u + n_v)")
    pairs = stored(pairs.selectExpr(*_PAIR))
    dropped(found)
    return sizes, pairs


#: The sizes that the partner in a link by frequent shingles can have at all.
_LEAST, _MOST = f"(n * {PERCENT} + 99) div 100", f"q * {100 + PERCENT} div {PERCENT} - n"


def _ranged(members: DataFrame) -> DataFrame:
    """members (key, id, root, n, big, q, ...) that may still have a link by
    frequent shingles, with the sizes, low to high, that its partner can have;
    keys whose members left are of one component go."""
    own = members.drop("low", "high").withColumn("s", salt("id"))
    ends = own.groupBy("key").agg(F.min("n").alias("least"), F.max("big").alias("most"), F.min("root").alias("a"), F.max("root").alias("b"), salts_seen("s").alias("seen")).where("a != b").drop("a", "b")
    own = own.join(per_salt(ends, "seen", "s").hint("shuffle_hash"), ["key", "s"])
    own = own.withColumn("low", F.expr(f"greatest(least, {_LEAST})"))
    own = own.withColumn("high", F.expr(f"least(most, big * 100 div {PERCENT}, {_MOST})"))
    return own.where("low <= high").drop("s", "least", "most")


def near_links(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """reps (doc_id, n, bands), docs (doc_id, text) -> (node, root) of linked ids."""
    members = stored(_hubs(reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"), F.col("n").cast("int").alias("n"))))
    met = stored(members.where("may").groupBy(F.col("hub").alias("u"), F.col("id").alias("v")).agg(F.count("*").alias("often")))
    sets = stored(_sets(docs, members.select(F.col("hub").alias("doc_id")).union(members.select("id")).distinct()))
    # each id with the hub it meets most often; this joins up most of a group
    first = _links(met.groupBy("v").agg(F.max_by("u", "often").alias("u")), sets)
    roots = components(first)
    # the other hubs, where that leaves several components
    roots = _joined(roots, _links(_apart(met.drop("often"), roots), sets))
    open_ = stored(_labelled(members.where("many"), roots))
    dropped(members, met, first)
    if open_.take(1):
        sizes, sharing = _shared(open_, sets)
        # each membership is joined once, of documents with enough frequent shingles
        able = stored(open_.join(sizes.where(f"{_LEAST} <= {_MOST}"), "id"))
        # an id has a key for each band at most
        members = stored(_ranged(able).withColumn("keys", F.collect_set("key").over(Window.partitionBy("id"))))
        pairs = _apart(_apart_with_all(members).union(sharing).distinct(), roots)
        roots = _joined(roots, _links(pairs, sets))
        dropped(sizes, sharing, able, members)
    dropped(sets, open_)
    return roots


def near_dedup(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the sets are named twice, which costs less than keeping every signature
    signed = docs.mapInArrow(_sign, _NAMED + ", bands array<long>").withColumn("s", salt("doc_id", "n"))
    rows = docs.mapInArrow(_name, _NAMED).withColumn("s", salt("doc_id", "n"))
    real = "n > 0 AND doc_id IS NOT NULL"
    classes = stored(signed.where(real).groupBy("c1", "c2", "n").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), salts_seen("s").alias("seen")))
    roots = near_links(classes, docs)
    by_class = classes.drop("bands").join(roots, F.col("doc_id") == F.col("node"), "left").select("c1", "c2", "n", "seen", F.coalesce("root", "doc_id").alias("component_id"))
    found = rows.where(real).join(per_salt(by_class, "seen", "s").hint("shuffle_hash"), ["c1", "c2", "n", "s"]).select("doc_id", "n", "component_id")
    alone = rows.where(f"NOT ({real})").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = found.union(alone)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN list_aggregate(ws, 'string_agg', ' ')
    ELSE list_aggregate(ws[i : i + 4], 'string_agg', ' ') END AS g
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 3, 2))) AS i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (
  SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach AS (
  SELECT u, u AS r FROM (SELECT DISTINCT u FROM both_ways)
  UNION SELECT reach.u, b.v FROM reach JOIN both_ways b ON reach.r = b.u),
c AS (SELECT u, min(r) AS root FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id,
       coalesce(c.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.u = d.doc_id
"""
