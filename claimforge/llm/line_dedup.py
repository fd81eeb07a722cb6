"""Fuzzy removal of repeated lines.

1. Every line is normalised to lower-case words; equal word sequences are one node, by a 64-bit hash.
2. A node has a SimHash of its character 6-grams, in six blocks of 14 bits. Nodes that agree on two
   blocks or more, as all within Hamming distance 4 do, meet in one of fifteen tables, one for each pair of blocks.
3. Pairs within a wide distance are verified by edit similarity of the normalised lines: first all of small
   buckets and those with the least and the greatest node of a large one, then all pairs of large buckets
   that these links leave in different groups.
4. Components of the verified pairs, and equal lines, are groups; of each group the first occurrence
   stays (least id, then least line number).

Signing, the pairs of a bucket and the edits of a pair are worked out over Arrow batches; all else is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimforge.llm.common import connected_components, discard, quoted, slices, store, tag

SIMILARITY = 0.8
#: Signatures with more other bits than this are not compared by edits.
DISTANCE = 16
#: Blocks of a signature and the bits of each; "low" holds the first four, "high" the other two.
N_BLOCKS, WIDTH, IN_LOW = 6, 14, 4
#: Nodes of a bucket before each one that it is compared with at once.
PREVIOUS = 4
TABLES = tuple(combinations(range(N_BLOCKS), 2))
#: Tables whose buckets are dealt out at a time.
AT_ONCE = 8
#: Rows up to which a stored side of a few numbers a row is broadcast; beyond it is shuffled.
SMALL = 200_000
#: Pairs whose edits one task counts, at most about.
PAIRS = 20_000
GRAM = 6
#: n-grams that are hashed at a time, and that one byte can count.
BLOCK, MOST = 1 << 14, 255

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
STRIP = " \t\r\n\x0b\x0c" + PUNCTUATION
TO_SPACE = bytes.maketrans(PUNCTUATION.encode(), b" " * len(PUNCTUATION))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@lru_cache(maxsize=None)
def bit_table() -> np.ndarray:
    """For each of 2 ** 16 hashes its bits in the signature, a byte for each bit, as eleven words."""
    n = np.arange(1, (1 << 16) + 1, dtype=np.uint64)
    bits = np.concatenate([mixed(n * np.uint64(m)).view(np.uint8).reshape(-1, 8) for m in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD)], axis=1)
    return np.unpackbits(bits[:, :11], axis=1, bitorder="little").view(np.uint64)


def words(line: Column) -> Column:
    """Lower-cased words of a line, split at white space and ASCII punctuation; [''] if it has none."""
    return F.split(F.btrim(F.lower(line), F.lit(STRIP)), r"[\s\p{Punct}]+")


def simhashes(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The two words (low, high) of the SimHash of each line; lines are not empty and hold no newline.

    A bit is set if more than half of the n-grams' hashes have it. Bits are counted in bytes, eight
    to a word, over stretches of at most ``MOST`` of them, and the stretches of a line are added up.
    """
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    # newlines end a line, so that no n-gram reaches into the next one
    gap = b"\n" * (GRAM - 1)
    text = np.frombuffer(gap.join(lines) + gap, np.uint8)
    first = np.concatenate([[0], np.cumsum(size + GRAM - 1)[:-1]])
    pieces = -(-(size + GRAM - 1) // MOST)
    owner = np.repeat(np.arange(len(lines)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = first[owner] + nth * MOST
    counts = np.empty((len(starts), 88), np.uint8)
    done = 0
    while done < len(starts):
        stop = max(done + 1, int(np.searchsorted(starts, starts[done] + BLOCK)))
        a, b = int(starts[done]), int(starts[stop]) if stop < len(starts) else len(text)
        part = text[a : b + GRAM - 1].astype(np.uint64)
        code = part[: b - a].copy()
        for k in range(1, GRAM):
            code[: len(part) - k] |= part[k : k + b - a] << np.uint64(8 * k)
        lanes = bit_table().take((mixed(code + np.uint64(1)) >> np.uint64(48)).astype(np.int32), 0)
        lanes[text[a:b] == 10] = 0
        counts[done:stop] = np.add.reduceat(lanes, starts[done:stop] - a, axis=0).view(np.uint8).reshape(-1, 88)
        done = stop
    total = np.add.reduceat(counts.astype(np.int32), np.cumsum(pieces) - pieces, axis=0)
    bits = (total * 2 > size[:, None])[:, : N_BLOCKS * WIDTH]
    weights = np.uint64(1) << np.arange(IN_LOW * WIDTH, dtype=np.uint64)
    low, high = bits[:, : IN_LOW * WIDTH], bits[:, IN_LOW * WIDTH :]
    return tuple((x * weights[: x.shape[1]]).sum(1, dtype=np.uint64).view(np.int64) for x in (low, high))


def line_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, dh, th, pos, node, chars, low, high) of all lines that have a word; dh and th stand for the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in (part for whole in batches for part in slices(whole, whole.column(3))):
            row, pos, found = [], [], []
            for i, t in enumerate(texts):
                if t is None:
                    continue
                for k, line in enumerate(t.lower().encode("utf-8", "surrogatepass").translate(TO_SPACE).split(b"\n")):
                    line = b" ".join(line.split())
                    if line:
                        row.append(i)
                        pos.append(k)
                        found.append(line)
            if not found:
                continue
            node = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)).view(np.int64)
            chars = np.fromiter((len(x) if x.isascii() else len(x.decode("utf-8", "surrogatepass")) for x in found), np.int32, len(found))
            low, high = simhashes(found)
            at = pa.array(row, pa.int32())
            made = [*(batch.column(c).take(at) for c in range(3)), pa.array(pos, pa.int32()), pa.array(node), pa.array(chars), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "dh", "th", "pos", "node", "chars", "low", "high"])

    kind = docs.schema[doc_id].dataType.simpleString()
    keyed = docs.select(F.col(doc_id).alias("doc_id"), *row_key(doc_id, text), F.col(text).alias("text"))
    return keyed.mapInArrow(run, f"doc_id {kind}, dh long, th long, pos int, node long, chars int, low long, high long")


def row_key(doc_id: str, text: str) -> list[Column]:
    return [F.xxhash64(F.col(doc_id).cast("string")).alias("dh"), F.xxhash64(F.col(text)).alias("th")]


def block(low: Column, high: Column, k: int) -> Column:
    word, nth = (low, k) if k < IN_LOW else (high, k - IN_LOW)
    return F.shiftrightunsigned(word, nth * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))


def close(a: str, b: str, similarity: float) -> Column:
    """Whether two entries are within the Hamming distance and their lengths allow the similarity."""
    x, y = F.col(f"{a}chars"), F.col(f"{b}chars")
    differ = reduce(Column.__add__, (F.bit_count(F.col(f"{a}{w}").bitwiseXOR(F.col(f"{b}{w}"))) for w in ("low", "high")))
    return (differ <= DISTANCE) & (F.least(x, y) >= F.greatest(x, y) * similarity - 1e-9)


def bucket_rows(nodes: DataFrame, similarity: float, tables: tuple[int, ...]) -> DataFrame:
    """(node, mate) of close nodes of a bucket, and (key, node, low, high, chars) of large buckets' nodes.

    The entries of a task come sorted by bucket and are read as a stream: each is compared with the first
    of its bucket and the ``PREVIOUS`` just before it, which is all if the bucket has no more than these.
    Larger buckets are given back as well, for :func:`crossing_pairs`. Nodes that meet in many tables are
    a pair in the first of these only: there they are one of a small bucket's pairs, or given back.
    """
    low, high = F.col("low"), F.col("high")
    keys = [F.shiftleft(F.lit(t).cast("long"), 2 * WIDTH).bitwiseOR(F.shiftleft(block(low, high, TABLES[t][0]), WIDTH)).bitwiseOR(block(low, high, TABLES[t][1])) for t in tables]
    names = ["key", "node", "low", "high", "chars"]
    table_of = np.array(TABLES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 6  # of the open bucket the first and the last rows, with their numbers
        for batch in batches:
            fresh = len(held[0])
            data = [np.concatenate([h, c.to_numpy(zero_copy_only=False).astype(np.int64)]) for h, c in zip(held, batch.columns)]
            key, node, low, high, chars = data
            n = len(key)
            if n == fresh:
                continue
            head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            first = np.repeat(head, np.diff(np.append(head, n)))
            nth = np.arange(n) - first
            if fresh:
                open_ = first == 0
                nth[open_] += held[5][-1] - (fresh - 1)
                nth[:fresh] = held[5]
            ends = np.append(head[1:], n) - 1
            last = np.repeat(nth[ends], np.diff(np.append(head, n)))

            def close(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                words = low[i] ^ low[j], high[i] ^ high[j]
                differ = np.bitwise_count(words[0].view(np.uint64)).astype(np.int32) + np.bitwise_count(words[1].view(np.uint64))
                x, y = chars[i], chars[j]
                one, two = table_of[key[i] >> 2 * WIDTH].T
                met = np.zeros(len(i), bool)  # in a table before this one
                for k in range(N_BLOCKS):
                    alike = (words[k // IN_LOW] >> k % IN_LOW * WIDTH) & ((1 << WIDTH) - 1) == 0
                    met |= alike & (k < two) & (k != one)
                return ~met & (differ <= DISTANCE) & (np.minimum(x, y) >= np.maximum(x, y) * similarity - 1e-9)

            new = np.arange(fresh, n)
            far = new[nth[fresh:] > PREVIOUS]
            pairs = [(far, first[far])]
            for d in range(1, PREVIOUS + 1):
                i = new[new - d >= first[new]]
                if not len(i):
                    break
                pairs.append((i, i - d))
            pairs = [(i[ok], j[ok]) for i, j in pairs if len(ok := close(i, j))]
            i, j = (np.concatenate([p[k] for p in pairs]) if pairs else np.empty(0, np.int64) for k in (0, 1))
            large = last > PREVIOUS
            large[:fresh] &= held[5][-1] <= PREVIOUS if fresh else False
            big = np.flatnonzero(large)
            none = np.zeros(len(i), np.int64)
            column = lambda x, y, absent: pa.array(np.concatenate([x, y]), pa.int64(), mask=np.repeat(absent, (len(i), len(big))))
            yield pa.RecordBatch.from_arrays(
                [column(node[j], big, [False, True])] + [column(none if x is not node else node[i], x[big], [x is not node, False]) for x in (key, node, low, high, chars)],
                names=["mate", *names],
            )
            tail = np.arange(head[-1], n)
            if len(tail) > PREVIOUS + 1:
                tail = np.concatenate([tail[:1], tail[-PREVIOUS:]])
            held = [x[tail] for x in (key, node, low, high, chars, nth)]

    keyed = nodes.select(F.explode(F.array(*keys)).alias("key"), "node", "low", "high", "chars")
    return keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "mate long, key long, node long, low long, high long, chars long")


def crossing_pairs(large: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all close pairs of nodes that the links so far leave in different groups; each once.

    In a bucket, one of two nodes in different groups is in another group than that of the least
    root: only such nodes are joined with the rest of the bucket.
    """
    w = Window.partitionBy("key")
    rooted = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ends = rooted.withColumns({"first": F.min("root").over(w), "last": F.max("root").over(w)}).filter("first <> last").drop("last")
    a, b = ends.filter("root <> first").alias("a"), ends.alias("b")
    once = (F.col("b.root") == F.col("b.first")) | (F.col("a.node") < F.col("b.node"))
    meet = (F.col("a.key") == F.col("b.key")) & (F.col("a.root") != F.col("b.root")) & once
    ordered = [F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")]
    return a.join(b, meet & close("a.", "b.", similarity)).select(*ordered).distinct()


def similar(a: str, b: str, similarity: float) -> bool:
    """Whether 1 - edits / length of the longer, in characters, is at least ``similarity``.

    What both lines begin and end with goes first. If few words are edited, whatever their length, the
    rest is similar; if not, its characters decide. Edits are counted with the columns of the edit table
    held as bits of whole numbers, until the last cell shows that there are too many.
    """
    most = int(max(len(a), len(b)) * (1 - similarity) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    ends = []
    for x, y in ((a, b), (a[::-1], b[::-1])):
        low, high = 0, min(len(a), len(b)) - sum(ends)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if x[low:mid] == y[low:mid] else (low, mid - 1)
        ends.append(low)
    a, b = (x[ends[0] : len(x) - ends[1]] for x in (a, b))
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a) <= most
    u, v = a.split(" "), b.split(" ")
    if edited(u, v, most // (1 + max(map(len, u + v)))):
        return True
    return edited(a, b, most)


def edited(a, b, most: int) -> bool:
    """Whether ``a`` becomes ``b`` by at most ``most`` edits of its items; ``b`` is not empty."""
    if abs(len(a) - len(b)) > most:
        return False
    where: dict = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, edits, left = full, 0, len(a), len(b)  # vertical steps of +1 and of -1; the last cell
    for c in b:
        eq = where.get(c, 0)
        flat = (((eq & up) + up) ^ up) | eq
        rise, fall = down | full & ~(flat | up), up & flat
        edits += bool(rise & last) - bool(fall & last)
        left -= 1
        if edits - left > most:
            return False
        eq |= down
        rise = rise << 1 | 1
        up, down = (fall << 1 | ~(eq | rise)) & full, rise & eq & full
    return edits <= most


def similar_pairs(pairs: DataFrame, n: int, similarity: float) -> DataFrame:
    """(a, b) of the ``n`` rows (a, b, x, y) whose lines x and y are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(x, y, similarity) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # the plan may have joined few but costly pairs into few tasks
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.select("a", "b", "x", "y").repartition(max(tasks, n // PAIRS)).mapInArrow(run, "a long, b long")


def node_texts(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, line) for stored ``nodes`` with the row and the place of their first occurrence."""
    wanted = store(nodes.groupBy("first.dh", "first.th").agg(F.collect_list(F.struct(F.col("first.pos").alias("pos"), "node")).alias("at")), "wanted")
    keyed = docs.select(*row_key(doc_id, text), F.col(text).alias("text"))
    texts = store(
        keyed.join(sided(wanted, nodes.count()), ["dh", "th"])
        .select(F.split("text", "\n").alias("all"), F.explode("at").alias("at"))
        .select("at.node", F.array_join(words(F.element_at("all", F.col("at.pos") + 1)), " ").alias("line"))
        .dropDuplicates(["node"]),
        "line-texts",
    )
    discard(wanted)
    return texts


def sided(df: DataFrame, numbers: int) -> DataFrame:
    """Broadcast a stored table that holds few numbers in all, join any other by shuffling."""
    return F.broadcast(df) if numbers <= SMALL else df.hint("merge")


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """Of ``(a, b)`` pairs of nodes those whose lines have the edit similarity."""
    pairs = store(pairs, "pairs")
    members = store(nodes.select("node", "first").join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node"), "pair-nodes")
    texts = node_texts(docs, members, doc_id, text)
    ends = [texts.select(F.col("node").alias(k), F.col("line").alias(v)) for k, v in (("a", "x"), ("b", "y"))]
    links = store(similar_pairs(pairs.join(ends[0], "a").join(ends[1], "b"), pairs.count(), similarity), "links")
    for made in (pairs, members, texts):
        discard(made)
    return links


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(dh, th, removed): the numbers of the lines to remove of each row that has any."""
    occurrences = store(line_rows(docs, doc_id, text), "lines")
    nodes = store(
        occurrences.groupBy("node").agg(F.min(F.struct("doc_id", "dh", "th", "pos")).alias("first"), F.count("*").alias("times"), *(F.max(c).alias(c) for c in ("chars", "low", "high"))),
        "line-nodes",
    )
    # a shorter line has no room for one edit
    fuzzy = nodes.filter(F.floor(F.col("chars") * (1 - similarity) + 1e-9) >= 1)
    parts = [store(bucket_rows(fuzzy, similarity, tuple(range(t, min(t + AT_ONCE, len(TABLES))))), "line-buckets") for t in range(0, len(TABLES), AT_ONCE)]
    shared = reduce(DataFrame.union, parts)
    met = shared.filter("mate is not null").select(F.least("node", "mate").alias("a"), F.greatest("node", "mate").alias("b")).distinct()
    links = verified(docs, nodes, met, doc_id, text, similarity)
    # links inside a group cannot change it, so of large buckets only pairs across groups are tested
    large = shared.filter("mate is null").drop("mate")
    crossing = verified(docs, nodes, crossing_pairs(large, connected_components(links), similarity), doc_id, text, similarity)
    for made in parts:
        discard(made)
    roots = connected_components(links.unionByName(crossing))
    grouped = nodes.select("node", "first", "times").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    linked = grouped.join(roots.select("root").distinct(), "root", "left_semi")
    keepers = linked.groupBy("root").agg(F.min("first").alias("keep"))
    repeated = (
        grouped.join(keepers, "root", "left")
        .withColumn("keep", F.coalesce("keep", "first"))
        .filter((F.col("times") > 1) | (F.col("keep") != F.col("first")))
        .select("node", "keep.dh", "keep.th", "keep.pos")
    )
    o, r = occurrences.select("node", "dh", "th", "pos").alias("o"), repeated.alias("r")
    gone = o.join(r, F.col("o.node") == F.col("r.node")).filter("not (o.dh = r.dh and o.th = r.th and o.pos = r.pos)")
    out = store(gone.groupBy("o.dh", "o.th").agg(F.array_distinct(F.collect_list("o.pos")).alias("removed")), "removed-lines")
    for made in (occurrences, nodes, links, crossing, roots):
        discard(made)
    return out


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, names: tuple[str, str] = ("n_lines", "removed")) -> DataFrame:
    """``docs`` with ``text`` reduced to the lines that stay, and ``n_lines`` and ``removed`` added, or as ``names`` has them.

    Lines are what newlines separate. Lines without a word are never removed. Lines too short for one
    edit at this similarity are removed only as repeats of equal words. ``removed`` lists the numbers of
    the removed lines from 0, ascending, and is empty if there are none.

    A null text stays null, with 0 lines; an empty text has one line. A null id counts as the least.
    Rows that are alike in id and text are one document and end alike. All other columns stay;
    such with one of the two names are replaced. An empty table gives an empty one. A line of
    any length is handled whole. Nodes are 64-bit hashes of word sequences.
    """
    gone = removals(docs, doc_id, text, similarity)
    removed = tag("removed")
    keys = [tag("dh"), tag("th")]
    base = docs.drop(*names)
    dh, th = row_key(doc_id, text)
    joined = base.join(gone.select(F.col("dh").alias(keys[0]), F.col("th").alias(keys[1]), F.col("removed").alias(removed)), (dh == F.col(keys[0])) & (th == F.col(keys[1])), "left")
    split = F.split(F.col(text), "\n")
    stay = F.filter(split, lambda _, i: ~F.array_contains(removed, i))
    cut = F.when(F.col(removed).isNull(), F.col(text)).otherwise(F.array_join(stay, "\n"))
    kept = [cut.alias(text) if c == text else base[quoted(c)] for c in base.columns]
    return joined.select(*kept, F.coalesce(F.size(split), F.lit(0)).alias(names[0]), F.sort_array(F.coalesce(removed, F.array().cast("array<int>"))).alias(names[1]))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines removed from each of all ``documents``, with a digest of what stays."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", (F.col("n_lines") - F.size("removed")).alias("n_kept"), "removed", F.length("text").alias("kept_chars"), F.md5("text").alias("kept_md5"))
