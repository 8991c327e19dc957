"""Near-duplicate documents by SetSketch registers.

A document is its set of 5-word shingles.  A register is the minimum of an
exponentially distributed hash over the set, kept as a truncated power of a base near
1: floor(1 - log_b(minimum)), within 0 .. Q + 1.  Registers of a union are the maxima of
the registers, and two sets share a register with a probability of about their Jaccard
similarity, so equal bands of registers propose candidates.  A candidate pair's
similarity is estimated from how many registers are larger, smaller and equal, by
maximum likelihood with the known set sizes; pairs that can't be ruled out so are
verified on their full sets.

Large groups.  Documents with equal sets are one class, formed by an aggregation.
Within a band's bucket, classes are compared with one chosen member (a star, linear in
the bucket), and the links found are united to components; buckets whose classes are all
in one component are done.  After a few such rounds, each with other members chosen,
classes of different components that still share a bucket, directly or through others,
form a family.  A family is compared in blocks of bounded size: by the registers, then,
where the estimate leaves a pair open, by the intersection of the sets' 32-bit hashes,
which can't be too small.  Only pairs that pass both are emitted and verified.  So no
pair is lost to a cap, and no bucket is expanded to all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewave.llm.common import LOWER, U64, column, hash_words, materialize, mix64, shingle_set, slices
from ratewave.llm.components import components

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 36, 7
REGISTERS = BANDS * ROWS
BASE, RATE, Q = 1.001, 20.0, 65_534
#: An estimate this far below the threshold (over five standard errors) rules a pair out.
MARGIN = 0.13
STAR_ROUNDS = 3
#: Members of a star that one task compares; classes of a block.
STAR_ROWS = 400
BLOCK = 512
TEXT_SLICE = 2 << 20

_RNG = np.random.default_rng(1)
_A = (_RNG.integers(0, 2**32, REGISTERS, dtype=np.uint32) | np.uint32(1))[:, None]
_B = _RNG.integers(0, 2**32, REGISTERS, dtype=np.uint32)[:, None]


def registers(shingles: np.ndarray) -> np.ndarray:
    """The SetSketch of a set of 64-bit shingle hashes that isn't empty."""
    x = (shingles >> U64(32)).astype(np.uint32)
    low = np.full(REGISTERS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 2048):  # hashes that stay in the cache
        part = x[at : at + 2048][None, :]
        for r in range(0, REGISTERS, 63):
            h = _A[r : r + 63] * part
            h += _B[r : r + 63]
            low[r : r + 63] = np.minimum(low[r : r + 63], h.min(axis=1))
    exponential = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, Q + 1).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band: a hash of the band's number and registers."""
    h = mix64(np.arange(BANDS, dtype=U64))
    for r in range(ROWS):
        h = mix64(h ^ regs.reshape(BANDS, ROWS)[:, r].astype(U64))
    return h


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the set."""
    a, b = mix64(shingles).sum(dtype=U64), mix64(shingles ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64)
    return int(a.astype(np.int64)), int((b + U64(len(shingles))).astype(np.int64))


def _log_p(x: np.ndarray) -> np.ndarray:
    p = -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)
    return np.clip(p, 1e-12, 1)


_GRID = np.linspace(0, 1, 201)


def similarity_estimate(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarities of pairs, from the numbers of registers of a that are
    larger and smaller than those of b, and the sizes of the sets."""
    larger, smaller, n_a, n_b = (np.asarray(v, dtype=float)[:, None] for v in (larger, smaller, n_a, n_b))
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    most = np.minimum(u / v, v / u)
    j = np.minimum(_GRID[None, :], most)
    up, down = _log_p(u - v * j), _log_p(v - u * j)
    same = np.clip(1 - up - down, 1e-12, 1)
    like = larger * np.log(up) + smaller * np.log(down) + (REGISTERS - larger - smaller) * np.log(same)
    return j[np.arange(len(j)), like.argmax(axis=1)]


def _shingles(texts: list[bytes]) -> list[np.ndarray]:
    return [shingle_set(words, SHINGLE) for words in hash_words([t.translate(LOWER) for t in texts])]


def sketch_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (of the text), n (set size), s1, s2 (signature), bands of every row; NULL
    and empty texts have n = 0 and no bands."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text", TEXT_SLICE):
            sets = _shingles(texts)
            marks = [signature(s) for s in sets]
            bands = [band_keys(registers(s)).astype(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            offsets = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "doc_id"),
                    column(part, "digest"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([m[0] for m in marks], pa.int64()),
                    pa.array([m[1] for m in marks], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(bands))),
                ],
                names=["doc_id", "digest", "n", "s1", "s2", "bands"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    return rows.mapInArrow(run, "doc_id long, digest long, n long, s1 long, s2 long, bands array<long>")


def _short(shingles: np.ndarray) -> np.ndarray:
    """The distinct upper halves of the hashes: two sets' have at least the sets' intersection."""
    return np.unique((shingles >> U64(32)).astype(np.uint32))


def _with_registers(rows: DataFrame) -> DataFrame:
    """(rep, text, s1, s2) -> (rep, n, regs, short, text), where the text has the signature."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text", TEXT_SLICE):
            sets = _shingles(texts)
            want = zip(column(part, "s1").to_pylist(), column(part, "s2").to_pylist(), strict=True)
            keep = [i for i, (s, w) in enumerate(zip(sets, want, strict=True)) if signature(s) == w]
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "rep").take(at),
                    pa.array([len(sets[i]) for i in keep], pa.int64()),
                    pa.array([registers(sets[i]).tobytes() for i in keep], pa.binary()),
                    pa.array([_short(sets[i]).tobytes() for i in keep], pa.binary()),
                    column(part, "text").take(at),
                ],
                names=["rep", "n", "regs", "short", "text"],
            )

    return rows.mapInArrow(run, "rep long, n long, regs binary, short binary, text string")


def _compare_with_center(percent: int):
    """Rows sorted by (center, salt, role): a center's text, then its star's members."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, own, own_regs = None, None, None
        for part, texts in slices(batches, "text", TEXT_SLICE):
            found: list[tuple[int, int]] = []
            cols = [column(part, c).to_pylist() for c in ("center", "salt", "role", "id", "n", "regs")]
            for (center, salt, role, i, n, regs), text in zip(zip(*cols, strict=True), texts, strict=True):
                regs = np.frombuffer(regs, dtype=np.uint16)
                if role == 0:
                    star, own, own_regs = (center, salt), _shingles([text])[0], regs
                    continue
                if star != (center, salt) or 100 * min(n, len(own)) < percent * max(n, len(own)):
                    continue
                up, down = int((own_regs > regs).sum()), int((own_regs < regs).sum())
                if similarity_estimate([up], [down], [len(own)], [n])[0] < percent / 100 - MARGIN:
                    continue
                other = _shingles([text])[0]
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(other) - both):
                    found.append((center, i))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return run


def verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (center, member) whose full sets are similar enough, as (a, b).

    A center with many members is dealt to several tasks, each with its own copy of the
    center's text, so each member's text moves once."""
    stars = pairs.groupBy("center").agg(F.ceil(F.count("*") / STAR_ROWS).alias("salts"))
    dealt = pairs.join(stars, "center").select(
        "center", "member", F.pmod(F.xxhash64("member"), F.col("salts")).alias("salt")
    )
    members = dealt.join(texts, dealt["member"] == texts["rep"]).select(
        "center", "salt", F.lit(1).alias("role"), F.col("member").alias("id"), "n", "regs", "text"
    )
    heads = dealt.select("center", "salt").distinct()
    heads = heads.join(texts, heads["center"] == texts["rep"]).select(
        "center", "salt", F.lit(0).alias("role"), F.col("center").alias("id"), "n", "regs", "text"
    )
    rows = heads.unionByName(members).repartition("center", "salt").sortWithinPartitions("center", "salt", "role")
    return rows.mapInArrow(_compare_with_center(percent), "a long, b long")


def _compare_blocks(percent: int):
    """Rows sorted by (family, i, j): the classes of two blocks of one family."""

    def pairs(rows: list[list]) -> Iterator[tuple[int, int]]:
        rep, comp, second = (np.array([r[k] for r in rows]) for k in (0, 1, 2))
        n = np.array([r[3] for r in rows], dtype=float)
        regs = np.stack([np.frombuffer(r[4], dtype=np.uint16) for r in rows])
        short = [np.frombuffer(r[5], dtype=np.uint32) for r in rows]
        across = second.any()  # two blocks: only pairs of one with the other
        for x in range(len(rows)):
            ok = (comp != comp[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
            ok &= (second & ~second[x]) if across else rep > rep[x]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            up, down = (regs[at] < regs[x]).sum(axis=1), (regs[at] > regs[x]).sum(axis=1)
            j = similarity_estimate(up, down, np.full(len(at), n[x]), n[at])
            for y in at[j >= percent / 100 - MARGIN].tolist():
                both = len(np.intersect1d(short[x], short[y], assume_unique=True))
                # sets that shrank in the cut to 32 bits may share as many more shingles
                both += int(n[x]) - len(short[x]) + int(n[y]) - len(short[y])
                if 100 * both >= percent * (n[x] + n[y] - both):
                    yield int(rep[x]), int(rep[y])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def flush() -> pa.RecordBatch:
            found = list(pairs(held))
            return pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["center", "member"]
            )

        for batch in batches:
            names = ("family", "i", "j", "rep", "comp", "second", "n", "regs", "short")
            for family, i, j, *row in zip(*[column(batch, c).to_pylist() for c in names], strict=True):
                if (family, i, j) != group:
                    if len(held) > 1:
                        yield flush()
                    group, held = (family, i, j), []
                held.append(row)
        if len(held) > 1:
            yield flush()

    return run


def _open_pairs(mixed: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(center, member): classes of different components of one family that may be linked.

    ``mixed``: (key, rep, comp, center), the buckets with several components."""
    stars = mixed.where("rep <> center.rep").select(F.col("center.rep").alias("a"), F.col("rep").alias("b"))
    families = components(stars).withColumnRenamed("comp", "family")
    rows = mixed.select("rep", "comp").distinct().join(families, "rep")
    sizes = rows.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(sizes, "family").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.join(texts.select("rep", "n", "regs", "short"), "rep")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "family",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "rep",
        "comp",
        (F.col("own") > F.col("other")).alias("second"),
        "n",
        "regs",
        "short",
    )
    rows = rows.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
    return rows.mapInArrow(_compare_blocks(percent), "center long, member long").distinct()


def link_classes(members: DataFrame, texts: DataFrame, percent: int, links: DataFrame | None = None) -> DataFrame:
    """rep, comp of the classes that have a link to another; comp is the smallest rep reachable.

    ``members``: (key, rep), the classes of each bucket with at least two.  ``links``: (a, b)
    that hold anyway."""
    tested = None
    labels = None if links is None else components(links)
    for turn in range(STAR_ROUNDS + 1):
        if labels is None:
            now = members.withColumn("comp", F.col("rep"))
        else:
            now = members.join(labels, "rep", "left").select("key", "rep", F.coalesce("comp", "rep").alias("comp"))
        # the bucket's chosen member: the smallest id at first and, for families, at last; by
        # another order in each round between
        order = F.xxhash64(F.lit(turn), "rep") if 0 < turn < STAR_ROUNDS else F.col("rep")
        buckets = now.groupBy("key").agg(
            F.min("comp").alias("lo"),
            F.max("comp").alias("hi"),
            F.min(F.struct(order.alias("o"), F.col("rep"), F.col("comp"))).alias("center"),
        )
        mixed = now.join(buckets.where("lo < hi").select("key", "center"), "key")
        if turn < STAR_ROUNDS:
            # of the stars a class is in, that of the member it shares most buckets with
            shared = mixed.where(F.col("comp") != F.col("center.comp")).groupBy(
                F.col("center.rep").alias("center"), F.col("rep").alias("member")
            ).agg(F.count("*").alias("times"))
            if tested is not None:
                shared = shared.join(tested, ["center", "member"], "left_anti")
            best = F.max(F.struct("times", (-F.col("center")).alias("c")))
            pairs = shared.groupBy("member").agg(best.alias("best")).select((-F.col("best.c")).alias("center"), "member")
        else:
            pairs = _open_pairs(materialize(mixed, "neardup_mixed"), texts, percent)
            if tested is not None:
                pairs = pairs.join(tested, ["center", "member"], "left_anti")
        pairs = materialize(pairs, "neardup_pairs")
        if pairs.isEmpty():
            if turn < STAR_ROUNDS:
                continue
            break
        found = materialize(verify(pairs, texts, percent), "neardup_links")
        both = pairs.unionByName(pairs.select(F.col("member").alias("center"), F.col("center").alias("member")))
        tested = both if tested is None else tested.unionByName(both)
        links = found if links is None else links.unionByName(found)
        if not found.isEmpty():
            labels = components(links)
    if labels is None:
        return members.select("rep", F.col("rep").alias("comp")).limit(0)
    return labels


def text_classes(rows: DataFrame, percent: int, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """(sketches, classes) of rows (doc_id, text): a row for each document, and a row (s1, s2,
    first, comp) for each different set, with the smallest (doc_id, digest) that has it and the
    number of its component.  ``by_id``: sets of one id are linked."""
    sketches = materialize(sketch_documents(rows), "neardup_sketches")
    usable = sketches.where("n > 0 AND doc_id IS NOT NULL")
    first = F.min(F.struct("doc_id", "digest")).alias("first")
    classes = usable.groupBy("s1", "s2").agg(first, F.first("bands").alias("bands"))
    # a class's number: ids can't name classes, as one id may have several texts
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "neardup_classes")
    links = _links_by_id(usable, classes) if by_id else None
    members = classes.select(F.explode("bands").alias("key"), "rep")
    shared = members.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    members = materialize(members.join(shared.select("key"), "key"), "neardup_members")
    wanted = classes.select("rep", "s1", "s2", "first.doc_id", "first.digest").join(members.select("rep").distinct(), "rep")
    texts = rows.withColumn("digest", F.xxhash64("text")).join(wanted, ["doc_id", "digest"]).select("rep", "s1", "s2", "text")
    texts = materialize(_with_registers(texts).dropDuplicates(["rep"]), "neardup_texts")
    labels = link_classes(members, texts, percent, links)
    numbered = classes.select("s1", "s2", "first", "rep").join(labels, "rep", "left")
    return sketches, numbered.select("s1", "s2", "first", F.coalesce("comp", "rep").alias("comp"))


def _links_by_id(usable: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(a, b): classes of one id, linked to one of them; None without ids of several texts."""
    sign = F.struct("s1", "s2")
    several = usable.groupBy("doc_id").agg(F.min(sign).alias("lo"), F.max(sign).alias("hi")).where("lo <> hi").select("doc_id")
    several = materialize(several, "neardup_ids")
    if several.isEmpty():
        return None
    own = usable.join(several, "doc_id").select("doc_id", "s1", "s2").join(classes, ["s1", "s2"]).select("doc_id", "rep").distinct()
    least = own.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return materialize(own.join(least, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b")), "neardup_id_links")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Documents are linked where 100 * intersection >= ``percent`` * union of their sets of
    5-word shingles (A-Z lower-cased; fewer words are one shingle).  ``component_id`` is
    the smallest id reachable.  NULL, empty and blank texts have no shingles and are linked
    with nothing.  Repeated rows are copies of each other; two different texts under one id
    are one vertex.  A row without an id is kept, unlinked, with a NULL component.  An empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches, classes = text_classes(rows, percent, by_id=True)
    names = classes.groupBy("comp").agg(F.min("first.doc_id").alias("id"))
    of_class = classes.select("s1", "s2", "comp").join(names, "comp").select("s1", "s2", "id")
    out = sketches.select("doc_id", "n", "s1", "s2").join(of_class, ["s1", "s2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("id")).otherwise(F.col("doc_id")))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, but for near copies: of each group of linked texts the
    one of the smallest id stays (of repeated rows of one id and text, one).  Texts are judged each
    for itself, so two unlike texts of one id both stay; rows without an id all stay."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches, classes = text_classes(rows, percent, by_id=False)
    chosen = classes.groupBy("comp").agg(F.min("first").alias("chosen"))
    of_class = classes.join(chosen, "comp").select("s1", "s2", "chosen")
    mine = F.struct("doc_id", "digest")
    out = sketches.where("n > 0 AND doc_id IS NOT NULL").join(of_class, ["s1", "s2"])
    gone = out.where(mine != F.col("chosen")).select(mine.alias("_gone")).distinct()
    own, digest = F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.col(f"`{text_col}`"))
    named = docs.where(own.isNotNull()).withColumn("_digest", digest)
    named = named.join(gone, (own == F.col("_gone.doc_id")) & (F.col("_digest") == F.col("_gone.digest")), "left_anti")
    order = Window.partitionBy(own, "_digest").orderBy(F.lit(0))
    named = named.withColumn("_copy", F.row_number().over(order)).where("_copy = 1").drop("_copy", "_digest")
    return named.unionByName(docs.where(own.isNull()))
