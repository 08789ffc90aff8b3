"""Token-ID output as sorted-string-table shards.

Documents are ranged by identifier and text over the tasks, each of which
encodes its texts and writes shards in key order; a shard ends at SHARD_BYTES
or SHARD_DOCS.  A shard is

    data blocks | block index | Bloom filter | footer

A block (zstd) holds entries: bytes shared with the previous key, further key
bytes and number of ids as varints, the further bytes, the ids as
little-endian unsigned 16- or 32-bit integers.  The index (zstd) has each
block's first key, place and documents; a lookup bisects it and reads one
block.  The footer has a fixed length, so a reader starts from the end.

A key is the identifier as 8 big-endian bytes with its sign bit flipped (so
bytes sort as numbers do), or no bytes for a null one, which sorts first.

Defined results: a null or empty text has only the end id; repeated
identifiers are all kept, ordered by a hash of their text; an empty table
makes no shards; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acervo.llm import text as tx
from acervo.llm.common import new_folder, stored

MAGIC = b"ACSST001"
#: index offset and bytes, filter offset and bytes, documents, ids, bytes an id; then MAGIC.
FOOTER = "<7Q"
BLOCK_BYTES, SHARD_BYTES, SHARD_DOCS = 256 << 10, 64 << 20, 1 << 18
#: So many documents of a shard are read at a time.
READ_DOCS = 1 << 14
BLOOM_BITS, BLOOM_HASHES = 10, 7

MANIFEST = "path string, part int, seq int, n_docs long, n_ids long, first_id long, last_id long, bytes long"


def place(path: str) -> tuple[pafs.FileSystem, str]:
    """The store that a folder's URI names, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & ((1 << 64) - 1))


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def put_varint(out: bytearray, n: int) -> None:
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)


def get_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def bloom_places(keys: list[bytes], bits: int) -> np.ndarray:
    """For each key, its bits in a filter of so many, by double hashing."""
    n = np.array([int.from_bytes(k, "big") + bool(k) for k in keys], np.uint64)
    with np.errstate(over="ignore"):
        a, b = tx.mix(n + np.uint64(0x9E3779B97F4A7C15)), tx.mix(n ^ np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
        return (a[:, None] + b[:, None] * np.arange(BLOOM_HASHES, dtype=np.uint64)) % np.uint64(bits)


class ShardWriter:
    """Writes one shard; keys must come in order."""

    def __init__(self, out, width: int) -> None:
        self.out, self.width, self.at = out, width, 0
        self.block, self.last, self.in_block, self.first = bytearray(), b"", 0, b""
        self.index, self.keys, self.ids = [], [], 0

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if not self.in_block:
            self.first, self.last = key, b""
        shared = 0
        while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
            shared += 1
        put_varint(self.block, shared)
        put_varint(self.block, len(key) - shared)
        put_varint(self.block, len(ids))
        self.block += key[shared:]
        self.block += ids.astype(f"<u{self.width}").tobytes()
        self.last, self.in_block = key, self.in_block + 1
        self.keys.append(key)
        self.ids += len(ids)
        if len(self.block) >= BLOCK_BYTES:
            self.flush()

    def write(self, data: bytes) -> tuple[int, int]:
        self.out.write(data)
        self.at += len(data)
        return self.at - len(data), len(data)

    def flush(self) -> None:
        if self.in_block:
            place, size = self.write(zstandard.ZstdCompressor(level=1).compress(bytes(self.block)))
            self.index.append((self.first, place, size, self.in_block))
            self.block, self.in_block = bytearray(), 0

    def close(self) -> int:
        self.flush()
        index = bytearray()
        for key, place, size, n in self.index:
            put_varint(index, len(key))
            index += key
            for x in (place, size, n):
                put_varint(index, x)
        index_at = self.write(zstandard.ZstdCompressor().compress(bytes(index)))
        bits = np.zeros(max(64, (len(self.keys) * BLOOM_BITS + 7) // 8 * 8), bool)
        bits[bloom_places(self.keys, len(bits)).ravel()] = True
        bloom_at = self.write(np.packbits(bits).tobytes())
        self.write(struct.pack(FOOTER, *index_at, *bloom_at, len(self.keys), self.ids, self.width) + MAGIC)
        return self.at


class ShardReader:
    """Reads one shard: get() by binary search, or all documents in order."""

    def __init__(self, path: str) -> None:
        store, inner = place(path)
        self.file = store.open_input_file(inner)
        end = self.file.size()
        tail = self.file.read_at(struct.calcsize(FOOTER) + len(MAGIC), end - struct.calcsize(FOOTER) - len(MAGIC))
        if tail[struct.calcsize(FOOTER) :] != MAGIC:
            raise ValueError(f"{path} is no shard")
        index_at, index_size, bloom_at, bloom_size, self.n_docs, self.n_ids, self.width = struct.unpack(FOOTER, tail[: struct.calcsize(FOOTER)])
        index, at, self.index = zstandard.ZstdDecompressor().decompress(self.file.read_at(index_size, index_at)), 0, []
        while at < len(index):
            n, at = get_varint(index, at)
            key, at = index[at : at + n], at + n
            entry = []
            for _ in range(3):
                x, at = get_varint(index, at)
                entry.append(x)
            self.index.append((key, *entry))
        self.bloom = (bloom_at, bloom_size)

    def block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, place, size, n = self.index[i]
        data, at, key = zstandard.ZstdDecompressor().decompress(self.file.read_at(size, place)), 0, b""
        for _ in range(n):
            shared, at = get_varint(data, at)
            more, at = get_varint(data, at)
            count, at = get_varint(data, at)
            key = key[:shared] + data[at : at + more]
            at += more
            yield key, np.frombuffer(data, f"<u{self.width}", count, at).astype(np.uint32)
            at += count * self.width

    def may_have(self, key: bytes) -> bool:
        bits = self.file.read_at(self.bloom[1], self.bloom[0])
        return all(bits[p >> 3] >> (7 - (p & 7)) & 1 for p in map(int, bloom_places([key], len(bits) * 8)[0]))

    def get(self, doc_id: int | None) -> np.ndarray | None:
        """The ids of the first document of this identifier."""
        key = key_of(doc_id)
        if not self.may_have(key):
            return None
        firsts = [e[0] for e in self.index]
        i = max(0, bisect_right(firsts, key) - 1)
        while i and firsts[i] == key:
            i -= 1
        for j in range(i, len(firsts)):
            if firsts[j] > key:
                break
            for k, ids in self.block(j):
                if k == key:
                    return ids
        return None

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.index)):
            yield from self.block(i)


class Encoded(NamedTuple):
    ids: np.ndarray
    starts: np.ndarray


#: Whose store of a worker this is, the most pieces of words whose ids it keeps (about 65 MB), and the text that it encodes at a time: less of both takes less memory and more time.
OWNER = "shards"
KEPT_PIECES, ENCODED_BYTES = 1_500_000, 8 << 20
#: Letters that stay one letter each when composed and in lower case (not so U+0130, which becomes two characters, or U+0958): a run of them is one run in the tokenizer too.
LETTER = "A-Za-zÀ-ÖØ-öø-įı-ſΑ-ΡΣ-Ωά-ώЀ-ҁא-תء-غف-يऄ-हก-ะḀ-ẕẠ-ỹぁ-ゖァ-ヺ一-龥가-힣"
#: Words of such letters alone are encoded so many at a time, as one text.
LETTERS, JOINED = f"^[{LETTER}]+$", 100
#: ASCII punctuation that ends a word after such a letter or a digit, without the apostrophe; words that end so, as what is before it, and it.
ENDING = r"!-&(-/:-@\[-`{-~"
TAIL = rf"(?s)^(?P<body>.*[0-9{LETTER}])(?P<tail>[{ENDING}]+)$"
#: Which bytes are such punctuation, and which are ASCII letters or digits.
PUNCTUATION, ALNUM = (np.array([bool(re.match(x, chr(c))) for c in range(256)]) for x in (f"[{ENDING}]", "[0-9A-Za-z]"))


def pieces(uniq: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Each word in lower case as its body and the punctuation that ends it, which are encoded apart with the same result; words that may hold a special token stay as they are. Distinct pieces, and the places of each word's two among them."""
    special = pc.match_substring(uniq, "<|")
    low = pc.if_else(special, uniq, pc.ascii_lower(uniq))
    data, offsets = tx.raw(low)
    ended = PUNCTUATION[data[offsets[1:] - 1]] & ~special.to_numpy(zero_copy_only=False)
    # one sign after an ASCII letter or digit is most of them; regular expressions find the others
    single = ended & ALNUM[data[offsets[1:] - 2]] & (np.diff(offsets) > 1)
    one, other = np.flatnonzero(single), np.flatnonzero(ended & ~single)
    cut = pc.extract_regex(low.take(pa.array(other)), TAIL)
    other, cut = other[cut.is_valid().to_numpy(zero_copy_only=False)], cut.drop_null()
    ones = low.take(pa.array(one))
    body = pa.concat_arrays([pc.utf8_slice_codeunits(ones, 0, -1), cut.field("body").cast(low.type)])
    tail = pa.concat_arrays([pc.utf8_slice_codeunits(ones, -1), cut.field("tail").cast(low.type)])
    some = np.concatenate([one, other])
    order = np.argsort(some)
    some, body, tail = some[order], body.take(pa.array(order)), tail.take(pa.array(order))
    mask = np.zeros(len(low), bool)
    mask[some] = True
    # a word without a tail has the empty piece
    coded = pa.concat_arrays([pc.replace_with_mask(low, pa.array(mask), body), tail, pa.array([""], low.type)]).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    bodies, tails = codes[: len(low)], np.full(len(low), codes[-1])
    tails[some] = codes[len(low) : -1]
    return coded.dictionary, bodies, tails


def runs(begins: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places of runs that begin there and are so long, one run after the other."""
    return np.repeat(begins - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())


class Pieces:
    """Pieces and their ids in arrays, each piece's after the one's before."""

    def __init__(self, tokenizer: str) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer)
        self.pieces, self.ids, self.sizes = pa.array([], pa.large_string()), np.empty(0, np.uint32), np.empty(0, np.int64)
        suffix = json.loads(self.tok.to_str())["model"].get("end_of_word_suffix")
        self.last = np.zeros(self.tok.get_vocab_size(with_added_tokens=True), bool)
        if suffix:
            self.last[[i for x, i in self.tok.get_vocab(with_added_tokens=True).items() if x.endswith(suffix)]] = True

    def keep(self, places: np.ndarray) -> None:
        """Forgets all but these."""
        begins = np.cumsum(self.sizes) - self.sizes
        self.pieces, self.ids, self.sizes = self.pieces.take(pa.array(places)), self.ids[runs(begins[places], self.sizes[places])], self.sizes[places]

    def encoded(self, some: pa.Array, together: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these and how many each has; so many are encoded as one text, which the ids that end a word divide again."""
        found = some.to_pylist()
        texts = found if together == 1 else [" ".join(found[i : i + together]) for i in range(0, len(found), together)]
        each = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        ids = np.fromiter(chain.from_iterable(each), np.uint32, int(sizes.sum()))
        if together == 1:
            return ids, sizes
        ends = np.flatnonzero(self.last[ids])
        if len(ends) != len(found) or ends[-1] != len(ids) - 1:
            return self.encoded(some, 1)
        return ids, np.diff(ends, prepend=-1)

    def add(self, new: pa.Array) -> np.ndarray:
        """Appends these and returns their places."""
        plain = pc.match_substring_regex(new, LETTERS).to_numpy(zero_copy_only=False) & self.last.any()
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        new, n = new.take(pa.array(order)), int(plain.sum())
        found = [self.encoded(new.slice(at, min(20_000, end - at)), together) for begin, end, together in ((0, n, JOINED), (n, len(new), 1)) for at in range(begin, end, 20_000)]
        at = np.empty(len(new), np.int64)
        at[order] = len(self.pieces) + np.arange(len(new))
        self.pieces, self.ids, self.sizes = pa.concat_arrays([self.pieces, new]), np.concatenate([self.ids, *(ids for ids, _ in found)]), np.concatenate([self.sizes, *(sizes for _, sizes in found)])
        return at

    def places(self, wanted: pa.Array, kept: int) -> np.ndarray:
        """The places of these distinct pieces; new ones are added, and if that would be more than `kept`, all that are not asked for go first."""
        hits = pc.index_in(self.pieces, wanted)
        found = np.flatnonzero(hits.is_valid())
        at = np.full(len(wanted), -1, np.int64)
        at[hits.drop_null().to_numpy()] = found
        new = np.flatnonzero(at < 0)
        if len(self.pieces) + len(new) > kept:
            self.keep(found)
            at[hits.drop_null().to_numpy()] = np.arange(len(found))
        at[new] = self.add(wanted.take(pa.array(new)))
        return at


def encoder(tokenizer: str, end_id: int, kept: int = KEPT_PIECES) -> Callable[[pa.Array], Encoded]:
    """Encodes texts with a tokenizer file that ignores case and whose pieces span neither white space nor the end of a run of letters: each distinct word of a batch is encoded once, in two pieces that a worker remembers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    store = tx.kept(OWNER)
    if store.get("file") != tokenizer:
        store |= {"file": tokenizer, "known": Pieces(tokenizer)}
    known = store["known"]

    def encode(column) -> Encoded:
        t = tx.texts(column)
        w = tx.words(pc.if_else(pc.match_substring(t, "<|"), t, pc.ascii_lower(t)))
        found, bodies, tails = pieces(w.uniq)
        places = known.places(found, kept)
        begins = np.cumsum(known.sizes) - known.sizes
        two = places[np.stack([bodies, tails], 1)]
        flat = known.ids[runs(begins[two].ravel(), known.sizes[two].ravel())]
        size = known.sizes[two].sum(1)
        begins, lens = np.cumsum(size) - size, size[w.codes]
        counts = tx.per_doc(lens, w.starts) + 1
        starts = np.concatenate([[0], np.cumsum(counts)])
        out = np.full(starts[-1], end_id, np.uint32)
        target = np.ones(starts[-1], bool)
        target[starts[1:] - 1] = False
        out[target] = flat[runs(begins[w.codes], lens)]
        return Encoded(out, starts)

    return encode


def vocabulary(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, shard_docs: int = SHARD_DOCS, kept: int = KEPT_PIECES, encoded_bytes: int = ENCODED_BYTES) -> DataFrame:
    """Writes the shards and returns their manifest, one row a shard in key order.

    A task that runs twice writes the same names; a file gets its name only when complete.
    """
    width = 2 if max(vocabulary(tokenizer), end_id + 1) <= 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, store, base = context.partitionId(), *place(folder)
        store.create_dir(base, recursive=True)
        encode = encoder(tokenizer, end_id, kept)
        rows, writer, seq, first, last = [], None, 0, None, None

        def close() -> None:
            nonlocal writer
            size = writer.close()
            out.close()
            store.move(temp, f"{base}/{name}")
            rows.append((f"{folder}/{name}", part, seq - 1, len(writer.keys), writer.ids, first, last, size))
            writer = None

        for b in tx.sliced(batches, limit=encoded_bytes, owner=OWNER):
            ids, starts = encode(b.column("text"))
            for i, doc_id in enumerate(b.column("doc_id").to_pylist()):
                if writer is None:
                    name, first = f"shard-{part:06d}-{seq:04d}.sst", doc_id
                    temp = f"{base}/_{name}.{context.taskAttemptId()}"
                    out = store.open_output_stream(temp)
                    writer, seq = ShardWriter(out, width), seq + 1
                writer.add(key_of(doc_id), ids[starts[i] : starts[i + 1]])
                last = doc_id
                if writer.at >= SHARD_BYTES or len(writer.keys) >= shard_docs:
                    close()
        if writer is not None:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(MANIFEST_NAMES, r, strict=True)) for r in rows], MANIFEST_SCHEMA)

    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest")).repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest")
    return stored(ranged.select("doc_id", "text").mapInArrow(run, MANIFEST), "manifest")


MANIFEST_NAMES = [c.split()[0] for c in MANIFEST.split(", ")]
MANIFEST_SCHEMA = pa.schema([(c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]]) for c in MANIFEST.split(", ")])


def read(manifest: DataFrame) -> DataFrame:
    """Reads the shards back: each document's place among all ids, its number of ids and their CRC-32."""
    before = F.sum("n_ids").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("path", F.coalesce(before, F.lit(0)).alias("start"))
    n = max(1, min(10_000, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), strict=True):
                shard = iter(ShardReader(path))
                while some := list(islice(shard, READ_DOCS)):
                    n_ids = np.array([len(ids) for _, ids in some], np.int64)
                    starts = start + np.cumsum(n_ids) - n_ids
                    start += int(n_ids.sum())
                    crc = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in some]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in ([id_of(key) for key, _ in some], starts, n_ids, crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.repartitionByRange(n, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, **more) -> DataFrame:
    """Writes the documents' ids to shards in a new shared folder and reads the files back."""
    return read(write(docs, new_folder(docs.sparkSession, "shards"), tokenizer, end_id, **more))
