"""Near-duplicates by circulant MinHash, banding and exact verification.

Two permutations of the universe of 32-bit shingle hashes generate the whole signature: the first
shuffles a document's shingles once, the second is shifted circularly by one place per coordinate,
and each coordinate is the smallest shifted value. Coordinates are banded; documents that share a
band are candidates; a link needs the exact similarity of the full shingle sets.

Documents with the same set are one class, of which one representative goes on. Inside a bucket pairs
are never enumerated. A bucket names pivots and compares them with the members that are not yet
connected to them; a pivot that has met its whole bucket is done there, and a bucket whose members are
all connected is finished. After one such round over the bands' buckets, what is not finished goes
into finer, exact buckets: two sets that are similar enough share one of their rarest shingles, and
only so many of the rarest need to be looked at. These buckets name more pivots from round to round,
the members nearest to the common text first, until no pair is left that could add a link. So no link
that the bands can see is lost, and a third of all documents that are near copies of one text take a
few comparisons each.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, keep
from .components import connected_components

SHINGLE_WORDS = 5
PERCENT = 80
BANDS = 28
ROWS = 5
# Exact buckets of up to so many members compare all of them at once; larger ones name up to so many
# pivots a round. The engine limits a rank before the shuffle up to 1000.
SMALL_BUCKET = 64
MOST_PIVOTS = 512
# Ids that may be broadcast to leave rows out before a shuffle: 16 MB, and a few times that as a table.
BROADCAST_IDS = 2_000_000
# Shingles whose coordinates are computed at once.
SLICE = 1 << 11
# Bytes of texts that are split and hashed at once, and the tables for it: A-Z in lower case, blanks
# (space and the controls from tab to carriage return), and a number per byte.
SLICE_BYTES = 1 << 20
# Words of more bytes have a hash of their own kind.
LONG_WORD = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
_NUMBERS = np.random.default_rng(9).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0xFF51AFD7ED558CCD)

SIGNATURES = "doc_id long, n_shingles long, class binary, bands array<long>"


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes.

    A text with fewer words is one shingle, a null or one without words has none. Texts with the same
    shingles have the same hashes; two different shingles of a pair of texts have the same hash in one
    case of 10^10 or fewer.
    """
    binary = pc.fill_null(texts.cast(pa.large_binary()), b"")
    at = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = np.frombuffer(binary.buffers()[2] or b"", np.uint8)
    cuts = np.flatnonzero(np.diff((at[1:] - at[0]) // SLICE_BYTES)) + 1
    bounds = [0, *cuts.tolist(), len(binary)]
    for first, last in zip(bounds, bounds[1:]):
        if last > first:
            offsets = at[first : last + 1]
            yield from _slice_sets(data[offsets[0] : offsets[-1]], offsets - offsets[0], words)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of texts that cut no word: a long text is hashed piece by piece."""
    start = 0
    while start < len(data):
        end = start + SLICE_BYTES
        if end < len(data):
            stop = int(offsets[np.searchsorted(offsets, end)])
            while end < stop and not (blanks := np.flatnonzero(_BLANK[data[end : min(stop, end + 4096)]])).size:
                end = min(stop, end + 4096)
            end = end + int(blanks[0]) if end < stop else stop
        yield start, min(end, len(data))
        start = end


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some texts begin, and a 64-bit hash of each."""
    filled = ~_BLANK[data]
    starting = filled.copy()
    starting[1:] &= ~filled[:-1]
    inner = offsets[offsets < len(data)]
    starting[inner] = filled[inner]
    starts = np.flatnonzero(starting)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    # A word is a polynomial of its bytes, modulo 2^64, and of its length. Long words could be made
    # to share one, whatever the base, and are hashed as a whole.
    number = np.cumsum(starting) - 1
    place = np.arange(len(data)) - starts[np.maximum(number, 0)]
    place[~filled] = 0
    place = np.minimum(place, LONG_WORD)
    powers = np.cumprod(np.full(LONG_WORD + 1, _BASE))
    values = _NUMBERS[_LOWER[data]]
    values *= powers[place]
    values[~filled] = 0
    hashes = np.add.reduceat(values, starts)
    lengths = np.add.reduceat(filled, starts, dtype=np.int64)
    hashes ^= lengths.astype(np.uint64) * _FACTOR
    hashes ^= hashes >> np.uint64(29)
    hashes *= _FACTOR
    hashes ^= hashes >> np.uint64(32)
    for i in np.flatnonzero(lengths > LONG_WORD):
        word = _LOWER[data[starts[i] : starts[i] + lengths[i]]]
        hashes[i] = xxhash.xxh3_64_intdigest(word.tobytes())
    return starts, hashes


def _slice_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    parts = []
    for begin, end in _pieces(data, offsets):
        own = offsets[(offsets >= begin) & (offsets < end)] - begin
        starts, hashes = _word_hashes(data[begin:end], own)
        parts.append((starts + begin, hashes))
    starts = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    if not len(starts):
        yield from (np.zeros(0, np.uint64) for _ in offsets[1:])
        return
    hashes = np.concatenate([p[1] for p in parts])
    # Shingles of one word, then two, and so on; a text takes the longest it has words for.
    bounds = np.searchsorted(starts, offsets)
    counts = np.diff(bounds)
    mixed = np.full(len(hashes), _BASE)
    short: dict[int, np.ndarray] = {}
    for j in range(words):
        mixed = mixed[: max(0, len(hashes) - j)]
        mixed ^= hashes[j:]
        mixed *= _FACTOR
        mixed ^= mixed >> np.uint64(32)
        for i in np.flatnonzero(counts == j + 1):
            short[int(i)] = mixed[bounds[i] : bounds[i] + 1].copy()
    for i, (first, n) in enumerate(zip(bounds.tolist(), counts.tolist())):
        if n > words:
            yield np.unique(mixed[first : first + n - words + 1])
        else:
            yield short.get(i, np.zeros(0, np.uint64))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """The same for one text."""
    return next(shingle_sets(pa.array([text], pa.large_string()), words))


def _mix(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit numbers: odd factors and shifts, each of which can be undone."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(first)
    x ^= x >> np.uint32(15)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a set of 64-bit hashes."""
    shuffled = _mix((hashes >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    result = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    # One shift moves by an odd step, so that all 2^32 shifts differ.
    shifts = (np.arange(coordinates, dtype=np.uint64) * 0x9E3779B1).astype(np.uint32)[:, None]
    for k in range(0, len(shuffled), SLICE):
        # The shifted permutation; its input is mixed already, and only the order of its high bits
        # matters.
        values = shuffled[None, k : k + SLICE] + shifts
        values *= np.uint32(0x2C1B3C6D)
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x297A2D39)
        np.minimum(result, values.min(axis=1), out=result)
    return result


def _signatures(words: int, bands: int, rows: int):
    salt = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def build(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sizes, classes, keys = [], [], []
            for hashes in shingle_sets(batch.column("text"), words):
                sizes.append(len(hashes))
                if len(hashes):
                    classes.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    keys.append(signature(hashes, bands * rows))
                else:
                    classes.append(None)
                    keys.append(np.zeros(bands * rows, np.uint32))
            table = np.stack(keys).reshape(-1, bands, rows) if keys else np.zeros((0, bands, rows))
            folded = np.zeros(table.shape[:2], np.uint64) + salt
            for r in range(rows):
                folded ^= table[:, :, r].astype(np.uint64)
                folded *= np.uint64(0xFF51AFD7ED558CCD)
                folded ^= folded >> np.uint64(32)
            lists = pa.FixedSizeListArray.from_arrays(
                pa.array(folded.astype(np.uint64).reshape(-1).view(np.int64)), bands
            ).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), lists],
                ["doc_id", "n_shingles", "class", "bands"],
            )

    return build


def _sets(words: int):
    """The sets of the rows that are of their node's class: an id may have other texts as well."""

    def build(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                hashes = list(shingle_sets(part.column("text"), words))
                own = [
                    xxhash.xxh3_128_digest(h.tobytes()) == wanted
                    for h, wanted in zip(hashes, part.column("class").to_pylist())
                ]
                sets = [np.sort(h.view(np.int64)) for h, mine in zip(hashes, own) if mine]
                at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(values))
                nodes = part.column("node").filter(pa.array(own, pa.bool_()))
                yield pa.RecordBatch.from_arrays([nodes, lists], ["node", "shingles"])

    return build


def _verified(percent: int):
    """Pairs whose sets are similar enough."""

    def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)

    def check(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            (at, values), (own_at, own_values) = lists(batch.column("member_set")), lists(batch.column("pivot_set"))
            linked = np.zeros(len(batch), bool)
            for i in range(len(batch)):
                other, mine = values[at[i] : at[i + 1]], own_values[own_at[i] : own_at[i + 1]]
                place = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                common = int((mine[place] == other).sum())
                linked[i] = 100 * common >= percent * (len(mine) + len(other) - common)
            yield pa.RecordBatch.from_arrays(
                [batch.column("component"), batch.column("pivot_component")], ["a", "b"]
            ).filter(pa.array(linked))

    return check


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * common shingles >= ``percent`` * all shingles of both. A text
    with fewer words than a shingle is one shingle; a null text or one without words has no shingles,
    is linked with nothing and is its own component. ``component_id`` is the smallest id that can be
    reached over links, ``kept`` whether that is the document's own. Rows with the same id are one
    node; a null id stays null and is kept.
    """
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    signed = keep(texts.mapInArrow(_signatures(shingle_words, bands, rows), SIGNATURES), "signatures")
    usable = signed.filter(F.col("class").isNotNull() & F.col("doc_id").isNotNull())

    # Aggregates are stored before they are joined with what they come from: only then can the engine
    # split a frequent key of that join.
    classes = usable.groupBy(F.col("class").alias("of")).agg(F.min("doc_id").alias("leader"))
    classes = keep(classes, "classes")
    # Members of a class, and rows that share an id, are linked through their class's leader.
    members = keep(
        usable.select("doc_id", "class", "n_shingles")
        .join(classes, F.col("class") == F.col("of"))
        .select("doc_id", "leader"),
        "members",
    )
    # A class is represented once, by the leader's signature. Its node is named by the class, since an
    # id with several texts may lead several classes, and it starts in the component of its leader.
    leaders = keep(
        usable.join(classes, (F.col("class") == F.col("of")) & (F.col("doc_id") == F.col("leader")))
        .withColumn("node", F.xxhash64("class"))
        .groupBy("node", "class", "leader")
        .agg(
            F.first("n_shingles").alias("size"),
            F.first("bands").alias("bands"),
            F.count(F.lit(1)).alias("rows"),
        ),
        "leaders",
    )
    # A node has one row, so a bucket counted twice has two nodes; should it be one twice, that bucket
    # is empty of pairs. What else is known of a node joins the few rows that are left.
    buckets = leaders.select("node", F.explode("bands").alias("bucket"))
    shared = keep(
        buckets.groupBy(F.col("bucket").alias("of")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("of"),
        "shared",
    )
    placed = keep(buckets.join(shared, F.col("bucket") == F.col("of"), "left_semi"), "placed")
    known = leaders.select(F.col("node").alias("of"), "size", F.col("leader").alias("component"))
    crowded = keep(
        placed.join(known, F.col("node") == F.col("of")).select("node", "size", "component", "bucket"), "buckets"
    )
    owners = leaders.select("node", "class", "leader", "rows")
    links = _bucket_links(crowded, owners, texts, shingle_words, percent)
    same = members.select(F.col("doc_id").alias("a"), F.col("leader").alias("b"))
    components = connected_components(same.unionByName(links))

    # Joined on the id, once per row; documents without a link are their own component.
    found = signed.select("doc_id", "n_shingles").join(
        components, F.col("doc_id") == F.col("node"), "left"
    )
    component = F.coalesce("component", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def one_of_each_group(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with all their columns, and one row of those that
    repeat an id and text. Rows without an id are all kept."""
    kept_id, rows, text, place = (fresh(n) for n in ("kept", "rows", "text", "place"))
    found = near_duplicates(docs, id_column, text_column, **options).filter("kept")
    kept = keep(found.groupBy(F.col("doc_id").alias(kept_id)).agg(F.count(F.lit(1)).alias(rows)), "kept")
    repeats = F.col(kept_id).isNotNull() & (F.col(rows) > 1)
    same = F.col(id_column).cast("long").eqNullSafe(F.col(kept_id))
    result = docs.join(kept.filter(~repeats), same, "left_semi")
    repeated = kept.filter(repeats)
    if not repeated.isEmpty():
        # The engine limits the rank before the shuffle, so a task sends one row of each.
        group = Window.partitionBy(id_column, text).orderBy(F.xxhash64(*docs.columns))
        own = docs.join(repeated, same, "left_semi").withColumn(text, F.xxhash64(text_column))
        first = own.withColumn(place, F.row_number().over(group)).filter(F.col(place) == 1)
        result = result.unionByName(first.select(*docs.columns))
    return result


def _bucket_links(
    crowded: DataFrame, owners: DataFrame, texts: DataFrame, shingle_words: int, percent: int
) -> DataFrame:
    """Links between representatives that connect all of them that share a bucket and a link."""
    nodes = crowded.select("node").distinct()
    owners = keep(owners.join(nodes, "node", "left_semi"), "owners")

    wanted = _only(texts, "doc_id", owners.select(F.col("leader").alias("wanted")))

    def sets_of(some: DataFrame) -> DataFrame:
        rows = wanted.join(some, F.col("doc_id") == F.col("leader")).select("node", "class", "text")
        return rows.mapInArrow(_sets(shingle_words), "node long, shingles array<long>")

    # One set per node: a leader that several rows repeat would count its shingles as often.
    sets = sets_of(owners.filter("rows = 1"))
    repeated = owners.filter("rows > 1")
    if not repeated.isEmpty():
        sets = sets.unionByName(sets_of(repeated).dropDuplicates(["node"]))
    sets = keep(sets, "sets")
    # At first every shingle may be shared.
    state = crowded.select("*", F.col("size").alias("shared"))
    links, left = _round(state, sets, 1, 1, percent)
    state = _prefix_buckets(left, sets, percent)
    # One pivot connects nearly all of a group of near copies; only what is left then needs more.
    pivots, small = 1, 1
    while not state.isEmpty():
        found, state = _round(state, sets, pivots, small, percent)
        links = links.unionByName(found)
        pivots, small = min(64 * pivots, MOST_PIVOTS), SMALL_BUCKET
    return links


def _only(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows with one of the ids of a stored one-column table. Up to ``BROADCAST_IDS`` ids are sent to
    the rows; with more the rows stay as they are, and the join that follows leaves the others out."""
    if wanted.count() > BROADCAST_IDS:
        return rows
    (name,) = wanted.columns
    return rows.join(F.broadcast(wanted), F.col(column) == F.col(name), "left_semi")


def _round(
    state: DataFrame, sets: DataFrame, pivots: int, small: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """New links, between the components that nodes had before, and what is left to compare without
    the pivots, which have met their buckets. A component is named by one of its nodes, so a link
    between components is as good as one between nodes."""
    ranked = keep(_ranked(state, pivots, small), "ranked")
    pairs = keep(_pairs(state, ranked, percent), "pairs")
    found = keep(_verify(pairs, sets, percent), "verified")
    components = connected_components(found)
    met = ranked.select(F.col("of").alias("b"), F.col("pivot").alias("n"))
    named = components.select(F.col("node").alias("of"), F.col("component").alias("c"))
    left = (
        state.join(met, (F.col("bucket") == F.col("b")) & (F.col("node") == F.col("n")), "left_anti")
        .join(named, F.col("component") == F.col("of"), "left")
        .withColumn("component", F.coalesce("c", "component"))
        .select("bucket", "node", "size", "shared", "component")
    )
    return found, _open(keep(left, "state"), percent)


def _possible(size: Column, other_size: Column, common: Column, percent: int) -> Column:
    """Whether two sets of these sizes can be similar enough with so many shingles in common."""
    return 100 * common >= percent * (size + other_size - common)


def _ranked(state: DataFrame, pivots: int, small: int) -> DataFrame:
    """The pivots of every bucket: ``pivots`` members, those with the fewest shingles of their own
    first, and later as many of those outside the bucket's top component; or all members of a bucket of at
    most ``small``. The limits apply before the shuffle, so a bucket sends that many rows per task."""
    most = max(pivots, small)
    central = Window.partitionBy("bucket").orderBy(F.col("size") - F.col("shared"), "node")
    place = F.row_number().over(central)
    sizes = state.groupBy(F.col("bucket").alias("of")).agg(F.count(F.lit(1)).alias("members"))
    first = (
        state.withColumn("place", place)
        .filter(F.col("place") <= most)
        .join(sizes, F.col("bucket") == F.col("of"))
        .filter((F.col("place") <= pivots) | (F.col("members") <= small))
        .drop("place", "of", "members")
    )
    if "top" in state.columns:
        outside = state.filter(~F.col("top")).withColumn("place", place)
        first = first.unionByName(outside.filter(F.col("place") <= pivots).drop("place")).distinct()
    return first.select(
        F.col("bucket").alias("of"),
        F.col("node").alias("pivot"),
        F.col("size").alias("pivot_size"),
        F.col("shared").alias("pivot_shared"),
        F.col("component").alias("pivot_component"),
    )


def _pairs(state: DataFrame, ranked: DataFrame, percent: int) -> DataFrame:
    """(member, pivot), each once, of members not yet connected to the pivot that could be linked."""
    common = F.least("shared", "pivot_shared")
    return (
        state.join(
            ranked,
            (F.col("bucket") == F.col("of"))
            & (F.col("component") != F.col("pivot_component"))
            & _possible(F.col("size"), F.col("pivot_size"), common, percent),
        )
        .select(F.col("node").alias("member"), "pivot", "component", "pivot_component")
        .distinct()
    )


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The components of the pairs that are links."""
    own = _only(sets, "node", pairs.select(F.col("member").alias("wanted")))
    theirs = _only(sets, "node", pairs.select(F.col("pivot").alias("wanted")))
    members = own.select(F.col("node").alias("m"), F.col("shingles").alias("member_set"))
    pivots = theirs.select(F.col("node").alias("p"), F.col("shingles").alias("pivot_set"))
    return (
        pairs.join(members, F.col("member") == F.col("m"))
        .select("pivot", "component", "pivot_component", "member_set")
        .join(pivots, F.col("pivot") == F.col("p"))
        .select("component", "pivot_component", "member_set", "pivot_set")
        .mapInArrow(_verified(percent), "a long, b long")
    )


def _prefix_buckets(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact buckets of the nodes that are left, in the columns of a state.

    With all shingles in one order, rarest first, two sets have nothing in common before their first
    common shingle, so at most ``shared``, the shingles from there on. Only the first shingles of a set,
    its rarest, can be that, and only those that any partner is small enough for.
    """
    nodes = keep(left.select("node", "size", "component").distinct(), "nodes")
    own = _only(sets, "node", nodes.select(F.col("node").alias("wanted"))).withColumnRenamed("node", "of")
    shingles = keep(
        nodes.join(own, F.col("node") == F.col("of"))
        .select("node", "size", "component", F.explode("shingles").alias("shingle")),
        "shingles",
    )
    counts = (
        shingles.groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("holders"))
        .filter(F.col("holders") > 1)
        .withColumnRenamed("shingle", "of")
    )
    place = F.row_number().over(
        Window.partitionBy("node", "size").orderBy(F.coalesce("holders", F.lit(1)), "shingle")
    )
    # The largest partner: 100 c >= percent (n + m - c), with c the shingles from here on.
    most = F.floor(F.col("shared") * ((100 + percent) / percent) + 1e-9) - F.col("size")
    least = F.ceil(F.col("size") * (percent / 100) - 1e-9)
    rows = (
        shingles.join(counts, F.col("shingle") == F.col("of"), "left")
        .withColumn("shared", F.col("size") - place + 1)
        # A shingle of one set only takes its place in the order but leads to nothing.
        .filter((100 * F.col("shared") >= percent * F.col("size")) & F.col("holders").isNotNull())
        .filter(least <= most)
        .select(F.col("shingle").alias("bucket"), "node", "size", "shared", "component")
    )
    return _open(keep(rows, "state"), percent)


def _open(state: DataFrame, percent: int) -> DataFrame:
    """What is worth comparing: members that something in their bucket could be linked with, in
    buckets whose members were not all connected. ``top`` marks the component that shares most."""
    # The component that shares most in each bucket, and what any other shares.
    ranked = (
        state.groupBy("bucket", "component")
        .agg(F.max("shared").alias("shared"))
        .withColumn(
            "place",
            F.row_number().over(
                Window.partitionBy("bucket").orderBy(F.desc("shared"), "component")
            ),
        )
        .filter(F.col("place") <= 2)
    )
    first = F.col("place") == 1
    best = ranked.groupBy(F.col("bucket").alias("of")).agg(
        F.max(F.when(first, F.col("component"))).alias("top"),
        F.max(F.when(first, F.col("shared"))).alias("top_shared"),
        F.max(F.when(~first, F.col("shared"))).alias("next_shared"),
    )
    theirs = F.when(F.col("component") == F.col("top"), F.col("next_shared")).otherwise(
        F.col("top_shared")
    )
    sizes = state.groupBy(F.col("bucket").alias("sized")).agg(F.min("size").alias("least_size"))
    best = keep(
        best.filter(F.col("next_shared").isNotNull()).join(sizes, F.col("of") == F.col("sized")), "best"
    )
    common = F.least(F.col("shared"), theirs)
    other = F.greatest("least_size", common)
    rows = (
        state.join(best, F.col("bucket") == F.col("of"))
        .filter(_possible(F.col("size"), other, common, percent))
        .withColumn("top", F.col("component") == F.col("top"))
        .select("bucket", "node", "size", "shared", "component", "top")
    )
    return keep(rows, "state")
