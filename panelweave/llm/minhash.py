"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard checks.

Two permutations make every signature coordinate: ``sigma`` (the finaliser of
the shingle hash) scatters a document's shingles over a ring of 2**32 places,
``pi`` ranks the places, and coordinate k is the least rank after turning the
ring by k steps. Documents whose bands agree are candidates; candidates are
checked on their full shingle sets.

No group is expanded into all its pairs. Documents with equal sets form one
class first. Within a bucket every class is checked against the bucket's
leader, another class in nearly every bucket of a large group, so a class meets
at most as many others as there are bands. The links' components are then
known, and only classes that still share a bucket with another component go to
an exact join on the rarest shingles of their sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelweave.llm import textvec as tv
from panelweave.llm.arrow import map_batches, texts, written
from panelweave.llm.graph import components
from panelweave.operators.groups import null_safe_join

COORDINATES = 192
#: Pairs with one leader that one task checks in a row.
CHUNK = 512
#: Cells of the table of shingle counts that orders prefixes.
CELLS = 1 << 20


def bands_for(percent: int, coordinates: int = COORDINATES, missed: float = 1e-5) -> tuple[int, int]:
    """Rows and bands: the longest rows that miss a pair at the threshold with at most that probability."""
    s = percent / 100
    rows = max(r for r in range(1, 33) if r == 1 or (1 - s**r) ** (coordinates // r) <= missed)
    return rows, coordinates // rows


def _pi(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the ring; works in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: np.ndarray, begin: np.ndarray, count: int = COORDINATES) -> np.ndarray:
    """``count`` coordinates of each non-empty set, one row per set; empty sets get the highest rank."""
    sizes = np.diff(begin)
    out = np.full((len(sizes), count), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        ring = (sets >> np.uint64(32)).astype(np.uint32)
        at = begin[:-1][full]
        for k in range(count):
            out[full, k] = np.minimum.reduceat(_pi(ring - np.uint32(k)), at)
    return out


def band_keys(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key per band, different for every band."""
    keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None], len(signature), 0)
    for r in range(rows):
        keys *= np.uint64(tv.BASE)
        keys += signature[:, r : rows * bands : rows]
    return tv.mix(keys)


#: Salts of the two 64-bit keys of a set.
NODE, CHECK = 0x51 << 48, 0x2B << 48


def _set_keys(sets: np.ndarray, begin: np.ndarray, salt: int = NODE) -> np.ndarray:
    """64 bits of each set: a sum over its members, mixed with its size."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tv.mix(sets ^ np.uint64(salt)))))
    return tv.mix(total[begin[1:]] - total[begin[:-1]] + np.diff(begin).astype(np.uint64)).view(np.int64)


def signed(docs: DataFrame, shingle: int, rows: int, bands: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``n_shingles``, the class ``node`` (documents of equal sets) and band keys.

    ``check`` are 64 further bits of the set, ``at`` a hash of the text.
    """

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, sets, begin in tv.shingle_sets(batch.column(1), shingle):
            keys = band_keys(signatures(sets, begin, rows * bands), rows, bands).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * bands, pa.int32()), pa.array(keys.ravel()))
            own = {"node": _set_keys(sets, begin), "check": _set_keys(sets, begin, CHECK)}
            yield {key: batch.column(0)[lo:hi], "n_shingles": np.diff(begin)} | own | {"at": batch.column(2)[lo:hi], "bands": lists}

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_shingles bigint, node bigint, check bigint, at bigint, bands array<bigint>"
    return map_batches(docs, [key, texts(docs, text), _text_hash(docs, text)], make, schema)


def _text_hash(docs: DataFrame, text: str) -> Column:
    return F.xxhash64(texts(docs, text)).alias("__at")


def _classes(seen: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows with their class, and one row per class: ``node``, its ``least`` key, a text's hash ``at``, ``check``.

    Documents are of one class if 128 bits of their sets agree: where documents
    of one ``node`` differ in ``check``, each check is a class of its own.
    """

    def made(rows: DataFrame) -> DataFrame:
        at = F.coalesce(F.min_by("at", key), F.min("at")).alias("at")
        check = [F.min("check").alias("check"), F.max("check").alias("__other")]
        return rows.where("n_shingles > 0").groupBy("node").agg(F.min(key).alias("least"), at, *check)

    classes = written(made(seen), "classes")
    torn = classes.where(F.col("check") != F.col("__other")).select(F.col("node").alias("__torn"))
    if torn.head(1):
        parted = F.when(F.col("__torn").isNotNull(), F.xxhash64("node", "check")).otherwise(F.col("node"))
        joined = seen.join(torn, F.col("node") == F.col("__torn"), "left")
        seen = written(joined.withColumn("node", parted).drop("__torn"), "signed")
        classes = written(made(seen), "classes")
    return seen, classes.drop("__other")


def _class_texts(docs, classes, crowded, shingle: int, key: str, text: str) -> DataFrame:
    """``node`` and one ``text`` of each class that shares a bucket with another.

    A class is joined to its texts by its least key and a text's hash, so that
    rows of one key, or of none, meet only the class of their own text.
    """
    wanted = classes.join(crowded.select("node").distinct(), "node")
    own = docs.select(F.col(key).alias("__least"), texts(docs, text).alias("text"), _text_hash(docs, text)).where("text != ''")
    same = F.col("least").eqNullSafe(F.col("__least")) & (F.col("at") == F.col("__at"))
    found = wanted.join(own, same).select("node", "check", "text")

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        # texts of one hash may be of several classes
        for lo, hi, sets, begin in tv.shingle_sets(batch.column(2), shingle):
            right = pa.array(_set_keys(sets, begin, CHECK) == batch.column(1)[lo:hi].to_numpy())
            yield {"node": batch.column(0)[lo:hi].filter(right), "text": batch.column(2)[lo:hi].filter(right)}

    return map_batches(found, ["node", "check", "text"], make, "node bigint, text string").dropDuplicates(["node"])


def _checked(pairs: DataFrame, of: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` of classes that are links.

    ``of`` has ``node`` and ``text`` of one document per class. The rows of
    one leader ``b`` are cut into chunks, so a leader of very many classes is
    spread over tasks.
    """
    sizes = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select(F.col("b").alias("node"), F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    leaders = of.join(sizes, "node")
    spread = leaders.select(
        F.col("node").alias("b"),
        F.col("text").alias("text_b"),
        "chunks",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )
    chunks = sizes.withColumnsRenamed({"node": "__b"})
    members = null_safe_join(pairs, chunks, {"b": "__b"}, "inner")
    members = members.join(of.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    members = members.withColumn("chunk", F.pmod(F.xxhash64("a"), F.col("chunks")).cast("int")).drop("chunks")
    both = members.join(spread.drop("chunks"), ["b", "chunk"])

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        a, b = batch.column(0), batch.column(1)
        keep = np.zeros(len(a), bool)
        last, known = None, None
        names, others = b.to_numpy(), batch.column(3)
        for lo, hi, sets, begin in tv.shingle_sets(batch.column(2), shingle):
            for i in range(lo, hi):
                if names[i] != last:
                    last, known = names[i], next(tv.shingle_sets(others[i : i + 1], shingle))[2]
                mine = sets[begin[i - lo] : begin[i - lo + 1]]
                common = len(np.intersect1d(mine, known, assume_unique=True))
                keep[i] = 100 * common >= percent * (len(mine) + len(known) - common)
        yield {"a": a.filter(pa.array(keep)), "b": b.filter(pa.array(keep))}

    return map_batches(both, ["a", "b", "text_a", "text_b"], make, "a bigint, b bigint")


def _prefixes(rest: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Rows (token, node, component, size, place) of the shingles of which linked classes share one.

    Any fixed order of all shingles makes the join exact: of a set of n, the
    first n - ceil(n * percent / 100) + 1 are enough. Rare shingles come first;
    how rare is read from a table of ``CELLS`` counts, whose size does not
    depend on the data.
    """

    def cells(batch: pa.RecordBatch) -> Iterator[dict]:
        total = np.zeros(CELLS, np.int64)
        for _, _, sets, _ in tv.shingle_sets(batch.column(0), shingle):
            total += np.bincount((sets & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        used = np.flatnonzero(total)
        yield {"cell": used, "n": total[used]}

    counted = map_batches(rest, ["text"], cells, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    rank = np.zeros(CELLS, np.int64)
    rank[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    rank = np.minimum(rank, (1 << 31) - 1).astype(np.int32)
    shared = rest.sparkSession.sparkContext.broadcast(rank)

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, sets, begin in tv.shingle_sets(batch.column(2), shingle):
            out, who = [], []
            for i in range(hi - lo):
                mine = sets[begin[i] : begin[i + 1]]
                order = np.lexsort((mine, shared.value[(mine & np.uint64(CELLS - 1)).astype(np.int64)]))
                out.append(mine[order[: len(mine) - -(-len(mine) * percent // 100) + 1]])
                who.append(np.full(len(out[-1]), lo + i))
            who = pa.array(np.concatenate(who)) if who else pa.array([], pa.int64())
            yield {
                "token": (np.concatenate(out) if out else sets[:0]).view(np.int64),
                "node": batch.column(0).take(who),
                "component": batch.column(1).take(who),
                "size": np.diff(begin)[who.to_numpy() - lo],
                "place": np.concatenate([np.arange(len(o)) for o in out]) if out else np.empty(0, np.int64),
            }

    return map_batches(
        rest, ["node", "component", "text"], make, "token bigint, node bigint, component bigint, size bigint, place bigint"
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    key: str = "doc_id",
    text: str = "text",
    coordinates: int = COORDINATES,
) -> DataFrame:
    """Per row of ``docs``: key, ``n_shingles``, ``component_id`` and ``kept``.

    Texts are linked if their sets of ``shingle``-word shingles have
    100 * intersection >= ``percent`` * union; ``component_id`` is the least
    key reachable over links. ``kept`` marks the rows that carry it. Texts
    without words (null too) are linked with nothing and keep their own key;
    rows repeated under one key get one result each. A null key is never least
    unless a component has no other, and such a row is kept only then.
    """
    rows, bands = bands_for(percent, coordinates)
    seen = written(signed(docs, shingle, rows, bands, key, text), "signed")
    seen, classes = _classes(seen, key)
    full = seen.where("n_shingles > 0")

    # buckets of two or more classes, each with its leader
    keyed = full.select("node", F.explode("bands").alias("bucket"))
    turned = F.col("node").bitwiseXOR(F.col("bucket"))
    led = keyed.groupBy("bucket").agg(F.min(turned).alias("first"), F.max(turned).alias("last"))
    leader = F.col("first").bitwiseXOR(F.col("bucket")).alias("leader")
    led = led.where("first != last").select(F.col("bucket").alias("__bucket"), leader)
    crowded = written(null_safe_join(keyed, led, {"bucket": "__bucket"}, "inner").distinct(), "crowded")
    pairs = crowded.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()

    of = written(_class_texts(docs, classes, crowded, shingle, key, text), "texts")
    links = written(_checked(pairs, of, shingle, percent), "confirmed")
    found = written(components(links), "components")

    # classes that meet another component in a bucket
    place = found.select(F.col("node").alias("__node"), "component")
    crowded = null_safe_join(crowded.select("bucket", "node"), place, {"node": "__node"}, "left")
    crowded = crowded.withColumn("component", F.coalesce("component", "node"))
    mixed = crowded.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low != high").select(F.col("bucket").alias("__bucket"))
    open_ = null_safe_join(crowded, mixed, {"bucket": "__bucket"}, "inner").select("node", "component").distinct()
    open_ = written(open_, "open")
    if open_.head(1):
        rest = written(open_.join(of, "node"), "rest")
        tokens = written(_prefixes(rest, shingle, percent), "prefixes")
        other = tokens.withColumnsRenamed({c: f"{c}_b" for c in tokens.columns})
        near = (
            tokens.join(other, F.col("token") == F.col("token_b"))
            .where("node < node_b and component != component_b")
            .where(f"100 * least(size, size_b) >= {percent} * greatest(size, size_b)")
            # at the first shared shingle, what follows must still hold the whole overlap
            .where(f"least(size - place, size_b - place_b) * {100 + percent} >= {percent} * (size + size_b)")
            .select(F.col("node").alias("a"), F.col("node_b").alias("b"))
            .distinct()
        )
        more = _checked(written(near, "near"), of, shingle, percent)
        found = written(components(written(links.unionByName(more), "confirmed")), "components")

    heads = null_safe_join(classes, found.withColumnRenamed("node", "__node"), {"node": "__node"}, "left")
    heads = heads.withColumn("component", F.coalesce("component", "node"))
    least = heads.groupBy(F.col("component").alias("__component")).agg(F.min("least").alias("component_id"))
    heads = null_safe_join(heads, least, {"component": "__component"}, "inner")
    heads = heads.select(F.col("node").alias("__node"), "component_id")
    out = null_safe_join(seen.drop("bands", "check", "at"), heads, {"node": "__node"}, "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(key)))
    return out.select(key, "n_shingles", "component_id", F.col(key).eqNullSafe(F.col("component_id")).alias("kept"))
