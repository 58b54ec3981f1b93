"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, table, written

#: Turns of a piece of a sequence; a row holds one piece at most.
PIECE = 256
#: Neighbouring sequences of a forest, and forests that are merged at a time.
SPAN, FAN = 4096, 64
#: Bytes of a turn's hash, and ids in a row of those that end at a node.
TOKEN, ENDS = 16, 4096
_BEFORE = ["b0", "b1", "b2", "b3"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, token, n): turns from 0 up by turn (null first), role and text, with a hash and the length of their text.

    Turns are sorted by range, so a conversation of any length is cut into runs, and only
    the sizes of its runs meet.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    token = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = written(rows.select("conv_id", F.monotonically_increasing_id().alias("place"), token.alias("token"), F.length("text").cast("long").alias("n")))
    rows = rows.withColumn("run", F.shiftright("place", 33))
    runs = rows.groupBy("conv_id", "run").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    earlier = F.coalesce(F.sum("size").over(Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("conv_id").alias("_c"), F.col("run").alias("_r"), (earlier - F.col("first")).alias("shift"))
    return rows.join(runs, (F.col("conv_id") == F.col("_c")) & (F.col("run") == F.col("_r"))).select("conv_id", (F.col("place") + F.col("shift")).alias("at"), "token", "n")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, d, token, n), d from 1: the head of the hundred's first conversation, then the own turns; and all conv_id."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("long")
    convs = turns.select("conv_id").distinct()
    heads = turns.filter("conv_id % 100 = 0 AND at < 5").select(F.col("conv_id").alias("root"), "at", "token", "n")
    taken = convs.withColumn("root", F.expr("conv_id - conv_id % 100")).join(heads, "root").filter(F.col("at") < h)
    taken = taken.select("conv_id", (F.col("at") + 1).alias("d"), "token", "n")
    starts = taken.groupBy(F.col("conv_id").alias("_c")).agg(F.max("d").alias("start"))
    own = turns.filter(F.col("at") >= h).join(starts, F.col("conv_id") == F.col("_c"), "left")
    own = own.select("conv_id", (F.coalesce("start", F.lit(0)) + F.col("at") - h + 1).alias("d"), "token", "n")
    return taken.unionByName(own), convs


def pieces_of(turns: DataFrame) -> DataFrame:
    """(conv_id, piece, key, cums, b0 .. b3, s0 .. s3) of (conv_id, d, token, n): PIECE turns a row.

    key has the tokens one after the other; cums[i] is the length of all texts up to the
    piece's turn i. s0 .. s3 are the length and three hashes of the piece, b0 .. b3 their
    sums over the pieces before it. Sums run over blocks of pieces, then over the blocks.
    """
    rows = turns.groupBy("conv_id", F.expr(f"(d - 1) div {PIECE}").alias("piece")).agg(F.array_sort(F.collect_list(F.struct("d", "token", "n"))).alias("t"))
    lengths = F.transform("t", lambda t: t["n"])
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)
    rows = rows.select("conv_id", "piece", F.unhex(F.array_join(F.transform("t", lambda t: t["token"]), "")).alias("key"), lengths.alias("lengths"))
    low = F.lit((1 << 32) - 1)
    hashes = [F.xxhash64("piece", "key").bitwiseAND(low), F.shiftrightunsigned(F.xxhash64("piece", "key"), 32), F.xxhash64(F.lit(1), "piece", "key").bitwiseAND(low)]
    rows = rows.select("*", total("lengths").alias("s0"), *[x.alias(f"s{i + 1}") for i, x in enumerate(hashes)], F.expr("piece div 1024").alias("block"))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    blocks = rows.groupBy("conv_id", "block").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(4)])
    over = Window.partitionBy("conv_id").orderBy("block")
    blocks = blocks.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), *[before(f"s{i}", over).alias(f"_{i}") for i in range(4)])
    inside = Window.partitionBy("conv_id", "block").orderBy("piece")
    rows = rows.select("*", *[before(f"s{i}", inside).alias(f"i{i}") for i in range(4)])
    rows = rows.join(blocks, (F.col("conv_id") == F.col("_c")) & (F.col("block") == F.col("_b")))
    rows = rows.select("*", *[(F.col(f"i{i}") + F.col(f"_{i}")).alias(f"b{i}") for i in range(4)])
    cums = F.transform(F.sequence(F.lit(0), F.size("lengths")), lambda i: F.col("b0") + total(F.slice("lengths", F.lit(1), i)))
    return written(rows.select("conv_id", "piece", "key", cums.alias("cums"), *_BEFORE, "s0", "s1", "s2", "s3"))


def _common(a: bytes, b: bytes) -> int:
    """Tokens that two keys begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TOKEN
    i = 0
    while a[i : i + TOKEN] == b[i : i + TOKEN]:
        i += TOKEN
    return i // TOKEN


def _sorted_neighbours(active: DataFrame, level: int) -> DataFrame:
    """(sid, len, n, start, shared, key) -> the same with pos and lcp, each group (start) sorted by its keys.

    Groups hold sequences alike up to this level; start is their first place and shared
    what the first of them has in common with the one before. Keys are sorted by range;
    only the first and last of each range meet to compare across borders. key stays on
    full pieces alone.
    """
    spark = active.sparkSession
    base, parts = level * PIECE, int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "part int, tail boolean, i long, sid long, len long, n long, start long, shared long, lcp long, key binary"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, i, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            start, shared, key = (batch.column(c).to_pylist() for c in ("start", "shared", "key"))
            lcp, kept = [], []
            for g, s, k in zip(start, shared, key, strict=True):
                lcp.append(None if last is None else base + _common(last[1], k) if last[0] == g else s)
                kept.append(k if last is None or len(k) == PIECE * TOKEN else None)
                last = g, k
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([False] * n), pa.array(range(i, i + n), pa.int64()), *(batch.column(c) for c in ("sid", "len", "n", "start", "shared")), pa.array(lcp, pa.int64()), pa.array(kept, pa.binary())],
                schema=names,
            )
            i += n
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip([part, True, i, None, None, None, last[0], None, None, last[1]], names, strict=True)], schema=names)

    names = pa.schema([("part", pa.int32()), ("tail", pa.bool_()), *((c, pa.int64()) for c in ("i", "sid", "len", "n", "start", "shared", "lcp")), ("key", pa.binary())])
    rows = active.select("sid", "len", "n", "start", "shared", "key").repartitionByRange(parts, "start", "key").sortWithinPartitions("start", "key")
    rows = written(rows.mapInArrow(scan, schema))

    def border(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["first"] = [s if g != g0 or k0 is None else base + _common(k0, k) for g, s, k, g0, k0 in zip(f.start, f.shared, f.key, f.start0, f.key0, strict=True)]
            yield f[["to", "offset", "first"]]

    # two rows of each range
    over = Window.orderBy("part", "tail")
    ends = rows.filter("tail OR i = 0").select(
        F.col("part").alias("to"), "tail", "start", "shared", "key", F.lag("start").over(over).alias("start0"), F.lag("key").over(over).alias("key0"),
        F.coalesce(F.sum(F.when(F.col("tail"), F.col("i"))).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    )
    ends = ends.filter("NOT tail").mapInPandas(border, "to int, offset long, first long")
    rows = rows.filter("NOT tail").join(F.broadcast(ends), F.col("part") == F.col("to")).withColumn("place", F.col("offset") + F.col("i"))
    least = rows.groupBy(F.col("start").alias("_s")).agg(F.min("place").alias("least"))
    return written(rows.join(least, F.col("start") == F.col("_s")).select("sid", "len", "n", "start", (F.col("start") + F.col("place") - F.col("least")).alias("pos"), F.coalesce("lcp", "first").alias("lcp"), "key"))


def sorted_sequences(pieces: DataFrame, sequences: DataFrame) -> DataFrame:
    """(sid, len, n) of distinct sequences -> (sid, len, n, pos, lcp): their places, and the turns shared with the one before (-1 for the first).

    Pieces are sorted one after the other; only sequences whose pieces so far equal
    another's go on, so there are as many rounds as the longest shared prefix has pieces.
    """
    active, found, level = sequences.select("*", F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("shared")), [], 0
    while True:
        own = pieces.filter(F.col("piece") == level).select("conv_id", "key")
        rows = active.join(own, F.col("sid") == F.col("conv_id"), "left").withColumn("key", F.coalesce("key", F.lit(b"")))
        rows = _sorted_neighbours(rows, level)
        full = rows.filter(F.length("key") == PIECE * TOKEN)
        alike = full.groupBy(F.col("start").alias("_s"), F.col("key").alias("_k")).agg(F.count("*").alias("_n"), F.min("pos").alias("_p"), F.min("lcp").alias("_l")).filter("_n > 1")
        if alike.isEmpty():
            found.append(rows.select("sid", "len", "n", "pos", "lcp"))
            break
        active = written(full.join(alike, (F.col("start") == F.col("_s")) & (F.col("key") == F.col("_k"))).select("sid", "len", "n", F.col("_p").alias("start"), F.col("_l").alias("shared")))
        found.append(rows.join(active.select("sid"), "sid", "left_anti").select("sid", "len", "n", "pos", "lcp"))
        level += 1
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _with_prefix(rows: DataFrame, pieces: DataFrame, depth: str, names: list[str]) -> DataFrame:
    """Adds, for the first `depth` turns of sid, the length of their texts and two hashes: equal for equal prefixes."""
    own = pieces.select(F.col("conv_id").alias("_c"), F.col("piece").alias("_p"), F.col("key").alias("_k"), "cums", *_BEFORE)
    at = F.col(depth) - F.col("_p") * PIECE
    prefix = [F.col(depth), F.col("b1"), F.col("b2"), F.col("b3"), F.expr(f"substring(_k, 1, cast(({depth} - _p * {PIECE}) * {TOKEN} as int))")]
    got = [F.element_at("cums", (at + 1).cast("int")), F.xxhash64(*prefix), F.xxhash64(F.lit(1), *prefix)]
    on = (F.col("sid") == F.col("_c")) & (F.expr(f"({depth} - 1) div {PIECE}") == F.col("_p")) & (F.col(depth) > 0)
    return rows.join(own, on, "left").select(*rows.columns, *[F.when(F.col("_c").isNull(), F.lit(0).cast("long")).otherwise(x).alias(n) for n, x in zip(names, got, strict=True)])


_FOREST = "open boolean, first boolean, last boolean, chunk long, pos long, lcp long, lcum long, l1 long, l2 long, depth long, cum long, s1 long, s2 long, n long, conv long, leaves long, kids long, below long, ends long, top long"
_NUMBERS = ["pos", "lcp", "lcum", "l1", "l2", "depth", "cum", "s1", "s2", "n", "conv", "leaves", "kids", "below", "ends"]


def merged_forest(frame: pd.DataFrame, chunk: int, whole: bool) -> pd.DataFrame:
    """Solves neighbours of one chunk: nodes that are complete, and what is left open at its borders, contracted.

    Edges join neighbours from the longest common prefix down. Parts joined at a depth
    below their own node's close that node and become its child there. A part next to an
    edge that can't be joined yet and has a longer prefix (one across the border, or one
    that waits for it) waits as well. The last row may be the next chunk's first, for the
    border.
    """
    frame = frame.sort_values("pos", kind="stable")
    cols = {c: frame[c].tolist() for c in _NUMBERS}
    lcp, lcum, l1, l2 = (cols[c] for c in ("lcp", "lcum", "l1", "l2"))
    depth, cum, s1, s2, n, conv, leaves, kids, below, ends = (cols[c] for c in _NUMBERS[5:])
    m = len(frame) - int(frame["last"].iloc[-1])
    walls = [*lcp, -1]
    for i in range(m):
        if leaves[i] < 0:
            leaves[i] = int(walls[i + 1] < depth[i])
    root, low, high = list(range(m)), list(range(m)), list(range(m))
    closed: list[tuple] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def lift(x: int, to: int, length: int, a: int, b: int) -> None:
        if depth[x] > to:
            closed.append((depth[x], cum[x], s1[x], s2[x], n[x], conv[x], leaves[x], kids[x], below[x], ends[x], to, a, b))
            below[x] += (n[x] - 1) * (cum[x] - length)
            depth[x], cum[x], s1[x], s2[x], kids[x], ends[x] = to, length, a, b, 1, -1

    for i in sorted(range(1, m), key=lambda i: -lcp[i]):
        at, x, y = lcp[i], find(i - 1), find(i)
        if max(walls[low[x]], walls[high[y] + 1]) > at:
            continue
        lift(x, at, lcum[i], l1[i], l2[i])
        lift(y, at, lcum[i], l1[i], l2[i])
        root[y], high[x] = x, high[y]
        n[x], conv[x], leaves[x], kids[x], below[x], ends[x] = n[x] + n[y], min(conv[x], conv[y]), leaves[x] + leaves[y], kids[x] + kids[y], below[x] + below[y], max(ends[x], ends[y])
    tops = [i for i in range(m) if root[i] == i]
    if whole:
        lift(tops[0], 0, 0, 0, 0)
        x = tops.pop()
        closed.append((0, 0, 0, 0, n[x], conv[x], leaves[x], kids[x], below[x], ends[x], -1, 0, 0))
    rest = {c: [cols[c][i] for i in tops] for c in _NUMBERS}
    # with all columns, as whole numbers of 64 bits, even where either has no rows
    done = pd.DataFrame(np.array(closed, np.int64).reshape(-1, 13), columns=[*_NUMBERS[5:], "top", "l1", "l2"])
    out = pd.concat([pd.DataFrame(rest, dtype=np.int64).assign(open=True, top=0), done.assign(open=False, pos=0, lcp=0, lcum=0)])
    return out.assign(first=[i == 0 and not whole for i in range(len(tops))] + [False] * len(closed), last=False, chunk=chunk)[[c.split()[0] for c in _FOREST.split(", ")]]


def _solver(whole: bool) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    return lambda key, frame: merged_forest(frame, key[0], whole)


def _forests(elements: DataFrame) -> DataFrame:
    """The trie's branching and ending nodes, each with the depth (top) of the node above it."""
    chunks = elements.agg(F.max("pos")).first()[0] // SPAN + 1
    zero = F.lit(0).cast("long")
    rows = elements.select(
        F.expr(f"pos % {SPAN} = 0").alias("first"), F.lit(False).alias("last"), F.expr(f"pos div {SPAN}").alias("chunk"), "pos", "lcp", "lcum", "l1", "l2", F.col("len").alias("depth"),
        "cum", "s1", "s2", "n", F.col("sid").alias("conv"), F.lit(-1).cast("long").alias("leaves"), zero.alias("kids"), zero.alias("below"), F.col("place").alias("ends"),
    )
    closed = None
    while True:
        whole = chunks == 1
        border = rows.filter("first AND chunk > 0").withColumns({"chunk": F.col("chunk") - 1, "last": F.lit(True)})
        solved = written(rows.unionByName(border).groupBy("chunk").applyInPandas(_solver(whole), _FOREST))
        done = solved.filter("NOT open")
        closed = done if closed is None else closed.unionByName(done)
        if whole:
            return closed
        rows = solved.filter("open").withColumn("first", F.col("first") & (F.col("chunk") % FAN == 0)).withColumn("chunk", F.expr(f"chunk div {FAN}")).drop("open", "top")
        chunks = -(-chunks // FAN)


def _hashed_ends(members: DataFrame) -> DataFrame:
    """(sid, ends_sha256): the SHA-256 of the ids of each sequence, ascending, fed row by row; a row has ENDS ids at most."""
    rows = members.groupBy("sid", F.expr(f"conv_id div {ENDS}").alias("part")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sid, digest = None, None
        for batch in batches:
            out = []
            for s, ids in zip(batch.column("sid").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if s == sid:
                    digest.update(b",")
                else:
                    if digest:
                        out.append((sid, digest.hexdigest()))
                    sid, digest = s, hashlib.sha256()
                digest.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.string()))], ["sid", "ends_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([sid], pa.int64()), pa.array([digest.hexdigest()])], ["sid", "ends_sha256"])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "sid").sortWithinPartitions("sid", "part").mapInArrow(run, "sid long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> a row for each node of the trie of rebuilt conversations.

    A conversation is rebuilt from the first h turns of the first of its hundred
    (conv_id - conv_id % 100; none if absent) and its own turns after its first h, h being
    crc32(conv_id) % 6. Turns are ordered by turn, null first, then by role and text; null
    roles and texts are empty, rows with a null conv_id take no part, rows that repeat are
    turns each, texts and conversations of any length are taken whole, other columns,
    whatever their names, take no part, and an empty table gives no node.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256): conv_id is the smallest conversation through the node.

    Distinct sequences (equal ones count as one, with their number) are sorted by hashes
    of their turns; each is one leaf of a forest, and the turns it shares with the one
    before are an edge. Chunks of neighbours join their edges from the deepest up by
    union-find; what is open at their borders is contracted and merged in larger chunks,
    until one is left. Nodes on the way between two of these (a single child, no end) are
    read off the pieces of the smallest conversation.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    turns, convs = rebuilt_turns(numbered_turns(conversations))
    pieces = pieces_of(turns)
    whole = pieces.groupBy(F.col("conv_id").alias("_c")).agg(F.max(F.expr(f"piece * {PIECE} + length(key) div {TOKEN}")).alias("len"), *[F.sum(f"s{i}").alias(f"w{i}") for i in (1, 2, 3)])
    same = ["len", "w1", "w2", "w3"]
    members = written(convs.join(whole, F.col("conv_id") == F.col("_c"), "left").select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in same]))
    sequences = written(members.groupBy(*same).agg(F.min("conv_id").alias("sid"), F.count("*").alias("n")))
    if sequences.isEmpty():
        return spark.createDataFrame([], schema)
    ends = _hashed_ends(members.join(sequences, same).select("sid", "conv_id")).withColumnRenamed("sid", "_e")
    places = sorted_sequences(pieces, sequences.select("sid", "len", "n"))
    elements = _with_prefix(_with_prefix(places, pieces, "len", ["cum", "s1", "s2"]), pieces, "lcp", ["lcum", "l1", "l2"])
    elements = written(elements.withColumn("place", F.col("pos")))
    nodes = _forests(elements)
    above = nodes.select(F.col("s1").alias("_1"), F.col("s2").alias("_2"), F.col("depth").alias("_d"), F.col("conv").alias("above"))
    nodes = nodes.join(above, (F.col("l1") == F.col("_1")) & (F.col("l2") == F.col("_2")) & (F.col("top") == F.col("_d")), "left")
    ended = elements.select(F.col("place").alias("_q"), F.col("sid").alias("_s")).join(ends, F.col("_s") == F.col("_e")).select("_q", "ends_sha256")
    nodes = nodes.join(ended, F.col("ends") == F.col("_q"), "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    apart = nodes.select("*", F.explode(F.sequence(F.expr(f"top div {PIECE}"), F.expr(f"(depth - 1) div {PIECE}"))).alias("_p")).filter("depth > 0")
    own = pieces.select(F.col("conv_id").alias("_c"), F.col("piece").alias("piece"), "cums")
    apart = apart.join(own, (F.col("conv") == F.col("_c")) & (F.col("_p") == F.col("piece")))
    apart = apart.select("*", F.explode(F.sequence(F.greatest("top", F.col("_p") * PIECE) + 1, F.least("depth", (F.col("_p") + 1) * PIECE))).alias("d"))
    last = F.col("d") == F.col("depth")
    text = F.col("cum") - F.element_at("cums", (F.col("d") - F.col("_p") * PIECE).cast("int"))
    inner = apart.select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.when(F.col("d") == F.col("top") + 1, F.col("above")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("kids")).otherwise(1).alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("below") + (F.col("n") - 1) * text).alias("saved_tokens"), F.coalesce(F.when(last, F.col("ends_sha256")), none).alias("ends_sha256"),
    )
    root = nodes.filter("depth = 0").select(
        F.col("conv").alias("conv_id"), "depth", F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("below").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
    return inner.unionByName(root)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
