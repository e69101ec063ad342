"""Token-id files of bit planes.

Documents are range-partitioned and sorted by id, encoded with a given
tokenizer, closed with an end id and written as files of about FILE_IDS ids
that hold whole documents.  In a file the ids are cut into blocks of BLOCK
ids; each block is transposed into bit planes (plane p has bit p of every id),
each plane is compressed with zstandard, and the file starts with an index of
its blocks and documents, so a reader (PlaneFile) can fetch one block, or one
document.

File layout (little-endian): MAGIC; u32 x 4: block size, blocks, documents,
bytes of the compressed document table; per block u32 ids, u32 planes, u64
offset; per plane u32 bytes; the document table (i64 id, u8 has-id, u32
ids, column by column); the planes.

Files are rows of a Parquet table in the shared folder (Spark's commit
protocol then covers lost executors); the columns beside the image are the
table's chunk index: part, place in the part, first id, ids, documents.

Defined results: null and empty text encode to the end id alone.  Rows with a
null id come first; rows of equal id are ordered by a hash of their text, and
rows equal in both, whose ids are the same, lie in any order and part anywhere
(a salt is the last sort key, so copies of one row that are a third of the
table are many tasks).  A text of any length is encoded whole, in one file.
Only the two columns named are read, so extra columns of any name do no harm.
An empty table gives an empty table of files.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import KEPT, scratch

MAGIC = b"TLPLANE1"
BLOCK, FILE_IDS, END_ID = 1 << 16, 1 << 20, 1
BATCH_BYTES = 8 << 20                 # text that is encoded together
CACHE_PIECES = 250_000                # pieces in each of the two generations a worker remembers


class PieceEncoder:
    """Ids of whole texts, as little-endian u32 bytes, equal to the library's.

    A tokenizer whose file says that it normalises by NFC, one space for white
    space and lower case, cuts by PATTERN and closes words with an end token
    treats every word between white space, and every piece of that pattern, on
    its own.  Texts of ASCII and of letters and signs that NFC leaves alone
    (PLAIN) are lower-cased and cut by the same pattern in Arrow, which also finds
    the different pieces of a batch; each piece's ids are taken from the library
    once and remembered (pieces not met since the last change of generation are
    forgotten), and the batch's ids are put together from them by place.  In other
    texts this holds for their plain words between ASCII white space; their other
    words, and words that may hold a special token, are given to the library as
    they stand.  A run of letters is one piece, closed by one end token, so many of
    them are encoded as one text and told apart; ASCII letters need the model
    alone, no normaliser.

    Any other tokenizer encodes whole texts.  Memory: about 200 bytes for each
    of the two generations' CACHE_PIECES pieces, 100 MB.
    """

    # The tokenizer file's own normaliser and pattern.
    NORMALIZER = {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    # Letters that are their own NFC form and have a lower case of one letter; signs that are neither letters nor digits.
    LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
    SIGNS = "\u00a1\u00a7\u00ab\u00b0\u00b7\u00bb\u00bf\u2013\u2014\u2018\u2019\u201c-\u201e\u2026\u20ac"

    _plain = re.compile(f"[\0-\x7f{LETTERS}{SIGNS}]*")
    # PATTERN for lower-cased plain text.
    _piece = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9]|[^\t-\r 0-9a-z{LETTERS}]+")

    # All but runs of letters: what white space is put around before a plain text is split at white space.
    _between = f"('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\t-\r 0-9a-z{LETTERS}]+)"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.by_piece = self._is_known(json.loads(self.tokenizer.to_str()))
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        if self.by_piece:
            self.letters = Tokenizer(self.tokenizer.model)
            self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.ends = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
            for token, i in self.tokenizer.get_vocab().items():
                self.ends[i] = token.endswith("</w>")

    @classmethod
    def _is_known(cls, made: dict) -> bool:
        cut = made["pre_tokenizer"] or {}
        steps = cut.get("pretokenizers") or [{}]
        return (made["normalizer"] == cls.NORMALIZER and made["post_processor"] is None
                and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
                and steps[0].get("pattern") == {"Regex": cls.PATTERN} and steps[0].get("behavior") == "Removed"
                and steps[0].get("invert") is True and not steps[1].get("add_prefix_space")
                and not steps[1].get("use_regex") and made["model"].get("end_of_word_suffix") == "</w>"
                and made["model"]["type"] == "BPE" and not made["model"].get("dropout")
                and made["truncation"] is None and made["padding"] is None
                and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["normalized"])
                        for t in made["added_tokens"]))

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_together(self, tokenizer, runs: list[bytes]) -> None:
        """Learn runs of letters, many to a text; those of a text with other pieces stay unknown."""
        for i in range(0, len(runs), 256):
            some = runs[i:i + 256]
            ids = self._ids(tokenizer, [b" ".join(some).decode()])[0]
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) == len(some):
                raw = ids.tobytes()
                self.known.update((w, raw[4 * a:4 * b]) for w, a, b in zip(some, [0, *cuts], cuts))

    def _again(self, new: set[bytes]) -> set[bytes]:
        """Those of `new` that the older generation does not hold either; the others are known again."""
        again = new & self.older.keys()
        self.known.update((p, self.older[p]) for p in again)
        return new - again

    def _learn(self, pieces: set[bytes]) -> None:
        pieces = self._again(pieces)
        self._learn_together(self.letters, [p for p in pieces if p.isalpha() and p.islower()])
        beyond = [p for p in pieces if not p.isascii() and (t := p.decode()).isalpha() and self._plain.fullmatch(t)]
        self._learn_together(self.tokenizer, beyond)
        rest = [p for p in pieces if p not in self.known]
        self.known.update((p, x.tobytes()) for p, x in zip(rest, self._ids(self.tokenizer, [p.decode() for p in rest])))

    def _pieces(self, word: bytes) -> list[bytes]:
        """What the word's ids are put together from."""
        if word.isalpha():
            return [word.lower()]
        text = word.decode()
        if "<|" in text or not self._plain.fullmatch(text):
            return [word]
        return [p.encode() for p in self._piece.findall(text.lower())]

    def _ids_of_words(self, words: list[bytes]) -> list[bytes]:
        new = set(filterfalse(self.known.__contains__, words))
        if new:
            cut = {w: self._pieces(w) for w in self._again(new)}
            self._learn(set().union(*cut.values()).difference(self.known))
            known = self.known.__getitem__
            self.known.update([(w, b"".join(map(known, p))) for w, p in cut.items() if w not in self.known])
        return list(map(self.known.__getitem__, words))

    def batch(self, texts: list[bytes | None]) -> list[bytes]:
        if not self.by_piece:
            return [x.tobytes() for x in self._ids(self.tokenizer, [(t or b"").decode() for t in texts])]
        if len(self.known) > CACHE_PIECES:
            self.older, self.known = self.known, {}
        whole = pc.fill_null(pa.array(texts, pa.large_string()), "")
        plain = pc.and_(pc.match_substring_regex(whole, f"\\A{self._plain.pattern}\\z"),
                        pc.invert(pc.match_substring(whole, "<|")))
        apart = pc.replace_substring_regex(pc.utf8_lower(whole), self._between, r" \1 ")
        split = pc.ascii_split_whitespace(pc.if_else(plain, apart, whole))
        words = split.values.dictionary_encode()
        ids = self._ids_of_words(words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist())
        made = pa.array(ids, pa.large_binary()).take(words.indices)          # the batch's ids, word by word
        _, places, data = made.buffers()
        if data is None:
            return [b""] * len(texts)
        cuts = np.frombuffer(places, np.int64, len(made) + 1)[split.offsets.to_numpy()].tolist()
        raw = data.to_pybytes()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def encoder_of(path: str) -> PieceEncoder:
    """One encoder per worker process: its memory serves all tasks that run there."""
    return PieceEncoder(path)


KEPT.append(encoder_of.cache_clear)   # stages of other operators need its memory


def _turned(octets: np.ndarray) -> np.ndarray:
    """Every eight bytes as an 8 x 8 matrix of bits, highest bit first, mirrored on its second diagonal.

    Row p of the answer is bit p of the eight bytes, the first byte's on top; applied twice it gives its input.
    """
    x = np.ascontiguousarray(octets.reshape(-1, 8)[:, ::-1]).view("<u8")
    for shift, mask in ((7, 0x00AA00AA00AA00AA), (14, 0x0000CCCC0000CCCC), (28, 0x00000000F0F0F0F0)):
        t = (x ^ (x >> np.uint64(shift))) & np.uint64(mask)
        x = x ^ t ^ (t << np.uint64(shift))
    return x.view(np.uint8)


def pack_block(ids: np.ndarray) -> list[bytes]:
    """Compressed bit planes of one block, lowest bit first, none above the highest set bit."""
    planes = max(1, int(ids.max()).bit_length()) if len(ids) else 0
    octets = np.zeros((-len(ids) % 8 + len(ids), 4), np.uint8)
    octets[:len(ids)] = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    out = []
    for p in range(planes):
        if p % 8 == 0:
            bits = _turned(octets[:, p // 8])
        out.append(squeeze(bits[:, p % 8].tobytes()))
    return out


def unpack_block(planes: list[bytes], n: int) -> np.ndarray:
    octets = np.zeros((-(-n // 8) * 8, 4), np.uint8)
    expand = zstandard.ZstdDecompressor().decompress
    for k in range(0, len(planes), 8):
        bits = np.zeros((len(octets) // 8, 8), np.uint8)
        for p, raw in enumerate(planes[k:k + 8]):
            bits[:, p] = np.frombuffer(expand(raw), np.uint8)
        octets[:, k // 8] = _turned(bits[:, ::-1])[:, ::-1].reshape(-1)
    return octets[:n].reshape(-1).view("<u4")


def pack_file(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    blocks = [pack_block(ids[i:i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    table = zstandard.ZstdCompressor().compress(
        np.array([d or 0 for d in doc_ids], "<i8").tobytes()
        + np.array([d is not None for d in doc_ids], np.uint8).tobytes() + np.array(lengths, "<u4").tobytes())
    head = MAGIC + struct.pack("<4I", BLOCK, len(blocks), len(doc_ids), len(table))
    at = len(head) + sum(16 + 4 * len(b) for b in blocks) + len(table)
    index = b""
    for k, b in enumerate(blocks):
        index += struct.pack(f"<2IQ{len(b)}I", min(BLOCK, len(ids) - k * BLOCK), len(b), at, *map(len, b))
        at += sum(map(len, b))
    return b"".join([head, index, table, *(p for b in blocks for p in b)])


class PlaneFile:
    """Reader of one file image: the index is read at once, planes of a block only when it is asked for."""

    def __init__(self, image: bytes):
        if image[:8] != MAGIC:
            raise ValueError("not a plane file")
        self.image = image
        self.block, n_blocks, n_docs, n_table = struct.unpack_from("<4I", image, 8)
        at, self.blocks = 24, []                                         # (ids, offset, bytes of every plane)
        for _ in range(n_blocks):
            n, planes, where = struct.unpack_from("<2IQ", image, at)
            self.blocks.append((n, where, struct.unpack_from(f"<{planes}I", image, at + 16)))
            at += 16 + 4 * planes
        table = zstandard.ZstdDecompressor().decompress(image[at:at + n_table])
        own = np.frombuffer(table, "<i8", n_docs).tolist()
        has = np.frombuffer(table, np.uint8, n_docs, 8 * n_docs)
        self.doc_ids = [d if h else None for d, h in zip(own, has)]
        self.lengths = np.frombuffer(table, "<u4", n_docs, 9 * n_docs)
        self.stops = np.cumsum(self.lengths, dtype=np.int64)

    def ids_of_block(self, k: int) -> np.ndarray:
        n, where, sizes = self.blocks[k]
        ends = np.cumsum((where, *sizes)).tolist()
        return unpack_block([self.image[a:b] for a, b in zip(ends, ends[1:])], n)

    def ids_of_document(self, place: int) -> np.ndarray:
        """Ids of the document at a place of the file, from the blocks that hold it."""
        stop = int(self.stops[place])
        start = stop - int(self.lengths[place])
        first = start // self.block
        parts = [self.ids_of_block(k) for k in range(first, -(-stop // self.block))]
        return np.concatenate(parts or [np.zeros(0, "<u4")])[start - first * self.block:stop - first * self.block]


def unpack_file(image: bytes) -> tuple[np.ndarray, list[int | None], np.ndarray]:
    """(ids, document ids, ids per document)."""
    file = PlaneFile(image)
    parts = [file.ids_of_block(k) for k in range(len(file.blocks))]
    return np.concatenate(parts) if parts else np.zeros(0, "<u4"), file.doc_ids, file.lengths


FILES = "part int, seq int, first_id long, n_ids long, n_docs long, image binary"
BACK = "part int, doc_id long, in_part long, n_tokens long, ids_crc32 long"


def write_files(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = END_ID) -> None:
    """Encode `df` into plane files under `path`, documents in ascending id order."""
    arrow = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
                       ("n_docs", pa.int64()), ("image", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        seq, first, docs, streams, held = 0, 0, [], [], 0

        def close():
            nonlocal seq, first, docs, streams, held
            ids = np.frombuffer(b"".join(streams), "<u4")
            image = pack_file(ids, docs, [len(s) // 4 for s in streams])
            row = [part], [seq], [first], [len(ids)], [len(docs)], [image]
            seq, first, docs, streams, held = seq + 1, first + len(ids), [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, arrow)], schema=arrow)

        waiting, texts, held_bytes = [], [], 0
        for b in chain(batches, [None]):
            if b is not None:
                waiting += b.column(0).to_pylist()
                texts += b.column(1).cast(pa.binary()).to_pylist()
                held_bytes += b.nbytes
                if held_bytes < BATCH_BYTES:
                    continue
            for d, ids in zip(waiting, encoder.batch(texts)):
                docs.append(d)
                streams.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= FILE_IDS:
                    yield close()
            waiting, texts, held_bytes = [], [], 0
        if docs:
            yield close()

    order = ["id", "hash", "salt"]
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    src = src.withColumns({"hash": F.xxhash64("text"), "salt": F.rand(3)})
    (src.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text").mapInArrow(encode, FILES)
     .write.option("compression", "none").parquet(path))


def read_files(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    files = spark.read.parquet(path)
    arrow = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("in_part", pa.int64()),
                       ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, first, image in zip(*(b.column(i).to_pylist() for i in range(3))):
                ids, docs, lengths = unpack_file(image)
                stop = np.cumsum(lengths, dtype=np.int64)
                crcs = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(stop.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(docs), pa.int32()), pa.array(docs, pa.int64()),
                     pa.array(first + stop - lengths, pa.int64()), pa.array(lengths.astype(np.int64)),
                     pa.array(crcs, pa.int64())], schema=arrow)

    # One row per part of the writing job: its ids, and the ids of the parts before it.
    sums = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = sums.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    back = files.select("part", "first_id", "image").mapInArrow(decode, BACK)
    return back.join(before, "part").select("doc_id", (F.col("before") + F.col("in_part")).alias("start"),
                                            "n_tokens", "ids_crc32")


def token_files(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files to the shared folder and read the documents back."""
    path = scratch(df.sparkSession, "planes")
    write_files(df, path, tokenizer, id_col, text_col)
    return read_files(df.sparkSession, path)
