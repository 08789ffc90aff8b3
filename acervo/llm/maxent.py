"""LM scoring with a hashed maximum-entropy model.

A word's 64-bit hash gives it one of CLASSES classes and, within the class,
one of MEMBERS members.  The probability of a word is that of its class, times
that of its member in the class, times its share of the counts of all words
that fall in the same member.  Class and member are softmaxes over hashed
features of the words before: the last word, the last two, and two skip
features (the second and the third last alone); the member's features are
crossed with the class.  Their biases are the logarithms of the corpus counts,
so that the untrained model is the smoothed unigram model.

The corpus becomes blocks of documents with each distinct word once, which
are tokenised once and read by all later passes.  Counts are summed over all
training documents.  Each round of training reads its own slice of the blocks
of all training documents: tasks take AdaGrad steps from the same weights and
the weighted mean of their changes is added.  The changes travel in slices,
which are summed by slice, so that the driver gets one table however many tasks
there are.  A model has a fixed size (4 MB); words and counts never go to the
driver, but meet each block by a join.

Defined results: a null or empty text is one token, the end; a null
identifier is held out; rows are scored apart; without training documents all
base scores are zero; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm import text as tx
from acervo.llm.common import stored

#: The end of a document counts as a token: a line feed, which is in no word.
END = xxhash.xxh64_intdigest(b"\n")
CLASSES, MEMBERS, ROWS = 16, 16, 1 << 15
BLOCK_BYTES = 4 << 20
ROUNDS, RATE, STEP_TOKENS = 3, 0.15, 16_384
#: The change of the weights travels in so many slices; a task of training takes so many partitions of blocks.
SLICES, TOGETHER = 16, 4
#: A word's place in a block and its block share one number: so many bits for the place, and for the block's number in its task.
PLACE_BITS, SEQ_BITS = 27, 16
#: Fixed values of the base score.
HELD_OUT, ADDED = 10, 0.1

BLOCK = "block long, doc_ids array<long>, held binary, starts binary, codes binary, words array<long>, n_train array<long>"


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT == 0


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each block of documents: identifiers, tokens as codes (each document's end included), the words' hashes by code, and how often training documents have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for seq, b in enumerate(tx.sliced(batches, limit=block_bytes)):
            w = tx.words(b.column("text"), lower=True)
            n_docs = b.num_rows
            starts = w.starts + np.arange(n_docs + 1)
            codes = np.full(starts[-1], len(w.uniq), np.int32)
            inner = np.ones(len(codes), bool)
            inner[starts[1:] - 1] = False
            codes[inner] = w.codes
            held = np.fromiter(map(held_out, b.column("doc_id").to_pylist()), bool, n_docs)
            n_train = np.bincount(codes[np.repeat(~held, np.diff(starts))], minlength=len(w.uniq) + 1)
            words = tx.signed(np.append(tx.hashed(w.uniq), np.uint64(END)))
            if seq >> SEQ_BITS or len(words) >> PLACE_BITS:
                raise ValueError(f"a task has over {1 << SEQ_BITS} blocks, or a block over {1 << PLACE_BITS} words: read the input in smaller partitions")
            cols = [[(part << SEQ_BITS) + seq], [b.column("doc_id").to_pylist()], [held.tobytes()], [starts.tobytes()], [packed(codes)], pa.ListArray.from_arrays([0, len(words)], pa.array(words)), pa.ListArray.from_arrays([0, len(words)], pa.array(n_train))]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=False)] + cols[5:], [x.split()[0] for x in BLOCK.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCK)


def packed(codes: np.ndarray) -> bytes:
    """The bytes of all codes, the lowest of each first, compressed: blocks are stored and shuffled."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 4).T).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1).T).view(np.int32).ravel()


class Block:
    """A block's tokens, read back from its row."""

    def __init__(self, row: dict) -> None:
        self.doc_ids = row["doc_ids"]
        self.held = np.frombuffer(row["held"], bool)
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.codes = unpacked(row["codes"])
        self.words = np.asarray(row["words"], np.int64).view(np.uint64)
        self.doc = np.repeat(np.arange(len(self.held)), np.diff(self.starts))


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.RecordBatch]]:
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1)
            columns = {c: row.column(c)[0] for c in ("doc_ids", "held", "starts", "codes")}
            yield Block({c: v.as_py() for c, v in columns.items()} | {"words": row.column("words").flatten().to_numpy()}), row


def slots(words: np.ndarray) -> np.ndarray:
    """Each word's class and member in one number."""
    return (words >> np.uint64(20) & np.uint64(CLASSES * MEMBERS - 1)).astype(np.int64)


def features(b: Block, slot: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows of the class table and of the member table for each token."""
    h = b.words[b.codes]
    before = []
    for k in (1, 2, 3):
        x = np.zeros(len(h), np.uint64)
        same = b.doc[k:] == b.doc[:-k]
        x[k:][same] = h[:-k][same]
        before.append(x)
    one, two, three = before
    keys = [one + np.uint64(1), tx.mix(one + np.uint64(2)) + two, tx.mix(two + np.uint64(3)), tx.mix(three + np.uint64(4))]
    crossed = (slot // MEMBERS + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mask = np.uint64(ROWS - 1)
    return [(tx.mix(k) & mask).astype(np.int32) for k in keys], [(tx.mix(k ^ crossed) & mask).astype(np.int32) for k in keys[:2]]


class Model(NamedTuple):
    """class_bias[c], member_bias[c, m], and weights for each row of hashed features."""

    class_bias: np.ndarray
    member_bias: np.ndarray
    classes: np.ndarray
    members: np.ndarray

    def logits(self, rows: list[np.ndarray], crossed: list[np.ndarray], cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z, y = np.tile(self.class_bias, (len(cls), 1)), self.member_bias[cls]
        for r in rows:
            z += self.classes[r]
        for r in crossed:
            y += self.members[r]
        return z, y


def softmax(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities, and the logarithm of their sum's scale."""
    top = z.max(1, keepdims=True)
    e = np.exp(z - top)
    total = e.sum(1, keepdims=True)
    return e / total, (top + np.log(total))[:, 0]


def log_sum(z: np.ndarray) -> np.ndarray:
    """The logarithm of the sum of the exponentials."""
    top = z.max(1)
    return top + np.log(np.exp(z - top[:, None]).sum(1))


def chunks(n: int, size: int) -> Iterator[slice]:
    for at in range(0, n, size):
        yield slice(at, at + size)


def stepped(found: Iterator[Block], model: Model, rate: float) -> tuple[np.ndarray, np.ndarray, int]:
    """The tables after AdaGrad steps over the training tokens, and how many there were."""
    classes, members, n = model.classes.copy(), model.members.copy(), 0
    squares = [np.full(ROWS, 1e-2, np.float32) for _ in range(2)]
    for b in found:
        slot = slots(b.words)[b.codes]
        rows, crossed = features(b, slot)
        train = np.flatnonzero(~b.held[b.doc])
        n += len(train)
        for part in chunks(len(train), STEP_TOKENS):
            k = train[part]
            cls, member = slot[k] // MEMBERS, slot[k] % MEMBERS
            here = np.arange(len(k))
            z, y = Model(model.class_bias, model.member_bias, classes, members).logits([r[k] for r in rows], [r[k] for r in crossed], cls)
            for table, square, x, right, used in ((classes, squares[0], z, cls, rows), (members, squares[1], y, member, crossed)):
                slope = softmax(x)[0]
                slope[here, right] -= 1
                at = np.concatenate([r[k] for r in used])
                order = np.argsort(at.astype(np.uint16), kind="stable")  # by radix: rows have 15 bits
                at = at[order]
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                at = at[first]
                slope = np.add.reduceat(np.ascontiguousarray(slope[order % len(k)].T), first, axis=1).T  # along memory
                square[at] += (slope**2).mean(1)
                table[at] -= rate * slope / np.sqrt(square[at])[:, None]
    return classes, members, n


def trained(found: DataFrame, bias: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """Each round moves the weights by the mean of what the tasks made of them, weighted by tokens."""
    model = Model(*bias, np.zeros((ROWS, CLASSES), np.float32), np.zeros((ROWS, MEMBERS), np.float32))
    context = found.sparkSession.sparkContext
    for i in range(rounds):
        sent = context.broadcast(tuple(model))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            old = Model(*sent.value)  # noqa: B023
            classes, members, n = stepped((b for b, _ in read(batches)), old, rate)
            change = np.concatenate([(classes - old.classes).ravel(), (members - old.members).ravel()]) * np.float32(n)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in np.split(change, SLICES)], pa.binary()), pa.array([n] * SLICES, pa.int64())], ["slice", "change", "n"])

        part = found.where(F.pmod(F.xxhash64("block"), F.lit(rounds)) == i).select("block", "doc_ids", "held", "starts", "codes", "words")
        part = part.coalesce(max(1, part.rdd.getNumPartitions() // TOGETHER))
        sums = part.mapInArrow(run, CHANGE).repartition(SLICES, "slice").mapInArrow(added, CHANGE).toArrow().sort_by("slice")
        if sums.num_rows:
            change = np.concatenate([np.frombuffer(x, np.float32) for x in sums["change"].to_pylist()]) / np.float32(sums["n"][0].as_py())
            model = model._replace(classes=model.classes + change[: ROWS * CLASSES].reshape(ROWS, CLASSES), members=model.members + change[ROWS * CLASSES :].reshape(ROWS, MEMBERS))
    return model


CHANGE = "slice int, change binary, n long"


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the changes of each slice."""
    change: dict[int, np.ndarray] = {}
    n: dict[int, int] = {}
    for b in batches:
        for i, x, k in zip(b.column("slice").to_pylist(), b.column("change"), b.column("n").to_pylist(), strict=True):
            x = np.frombuffer(x.as_buffer(), np.float32)
            change[i], n[i] = (change[i] + x if i in change else x.copy()), n.get(i, 0) + k
    yield pa.RecordBatch.from_arrays([pa.array(list(change), pa.int32()), pa.array([x.tobytes() for x in change.values()], pa.binary()), pa.array(list(n.values()), pa.int64())], ["slice", "change", "n"])


def counted(found: DataFrame) -> DataFrame:
    """(word, c) of all words of the training documents, by hash."""
    each = found.select(F.explode(F.arrays_zip("words", "n_train")).alias("w")).select(F.col("w.words").alias("word"), F.col("w.n_train").alias("n"))
    return each.where("n > 0").groupBy("word").agg(F.sum("n").alias("c"))


def totals(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each slot."""
    slot = F.shiftright("word", 20).bitwiseAND(F.lit(CLASSES * MEMBERS - 1))
    n, v = np.zeros(CLASSES * MEMBERS), np.zeros(CLASSES * MEMBERS)
    for r in counts.groupBy(slot.alias("slot")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        n[r.slot], v[r.slot] = r.n, r.v
    return n, v


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(docs: DataFrame, rounds: int = ROUNDS, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document's base score and the trained model's log10 probability."""
    found = stored(blocks(docs, block_bytes), "blocks")
    counts = stored(counted(found), "counts")
    n_slot, v_slot = totals(counts)
    n, v = n_slot.sum(), v_slot.sum()
    mass = n_slot + ADDED * (v_slot + 1)
    by_class = mass.reshape(CLASSES, MEMBERS).sum(1)
    bias = (np.log(by_class / by_class.sum()).astype(np.float32), np.log(mass.reshape(CLASSES, MEMBERS) / by_class[:, None]).astype(np.float32))
    sent = docs.sparkSession.sparkContext.broadcast((tuple(trained(found, bias, rounds, rate)), mass))

    places = found.select("block", F.posexplode("words").alias("pos", "of_word")).select("of_word", (F.shiftleft("block", PLACE_BITS) + F.col("pos")).alias("place"))
    pos = F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    known = places.join(counts, F.col("of_word") == F.col("word")).groupBy(F.shiftright("place", PLACE_BITS).alias("in_block")).agg(F.collect_list(pos).alias("pos"), F.collect_list("c").alias("c"))
    met = found.join(known, F.col("block") == F.col("in_block"), "left").select("doc_ids", "held", "starts", "codes", "words", "pos", "c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, mass = sent.value
        model = Model(*weights)
        for b, row in read(batches):
            c = np.zeros(len(b.words))
            c[row.column("pos").flatten().to_numpy()] = row.column("c").flatten().to_numpy()
            slot = slots(b.words)
            share = np.log10((c + ADDED) / mass[slot])
            base = np.log10((c + ADDED) / (n + ADDED * (v + 1)))
            slot = slot[b.codes]
            rows, crossed = features(b, slot)
            log = np.empty(len(slot))
            for k in chunks(len(slot), STEP_TOKENS):
                cls, member = slot[k] // MEMBERS, slot[k] % MEMBERS
                here = np.arange(len(cls))
                z, y = model.logits([r[k] for r in rows], [r[k] for r in crossed], cls)
                log[k] = (z[here, cls] - log_sum(z)) + (y[here, member] - log_sum(y))
            total = lambda x: np.add.reduceat(x, b.starts[:-1])  # noqa: B023, E731
            cols = [b.doc_ids, b.held, np.diff(b.starts), total((c > 0)[b.codes].astype(np.int64)), np.full(len(b.held), int(n)), total(base[b.codes]), total(log / np.log(10) + share[b.codes])]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()], strict=True)], [x.split()[0] for x in SCORES.split(", ")])

    return met.mapInArrow(run, SCORES)
