"""Token-id output with a shared zstandard dictionary.

Texts are encoded in ascending id order, each document's ids end with an end id,
and each document is compressed on its own with one dictionary trained on
serialized id arrays, so a short document is read without its neighbours.

The format is a folder that Spark writes, so it can be in any store Spark reaches:

* ``dictionary``: one row (hash, bytes, width, kind): SHA-256 and bytes of the dictionary,
  the bytes of an id, and whether it was trained or, of a sample that is too small to
  train on, is the sample itself (raw);
* ``blocks``: rows (part, block, dict_hash, min_id, max_id, n_docs, n_tokens, doc_ids,
  counts, offsets, payload).  ``part`` then ``block`` is the order of documents; doc_ids,
  counts and offsets are little-endian arrays (int64, uint32, uint64) that index the
  frames in the payload.  A null id is written as the smallest int64.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import kernel
from tidemark.llm.runtime import blob, lowest, partitions, scratch, ship, spans, table

U64 = np.uint64

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: The dictionary is trained on the ids of at most so many documents, none longer than SAMPLE_CHARS.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 50_000
DICTIONARY_BYTES = 65_536
#: A sample of fewer bytes or documents than these is the dictionary itself.
TRAIN_BYTES, TRAIN_DOCS = 65_536, 32
BLOCK_BYTES = 4 << 20
#: Text that a task encodes, about.
PART_BYTES = 16 << 20
#: Pieces of text whose ids a worker remembers, and ids of them.
CACHE = 2_000_000
CACHE_IDS = 16_000_000
#: Pieces of up to so many bytes are found by arrays, longer ones one by one.
SHORT = 16
_NULL_ID = -(1 << 63)

_BLOCKS = "part int, block int, dict_hash string, min_id long, max_id long, n_docs long, n_tokens long, doc_ids binary, counts binary, offsets binary, payload binary"
_BLOCK_SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("dict_hash", pa.string()), ("min_id", pa.int64()), ("max_id", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.binary()), ("counts", pa.binary()), ("offsets", pa.binary()), ("payload", pa.binary())])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Marks that a pre-token never joins to a letter before them (an apostrophe may belong to letters after it).
_MARK = np.zeros(256, bool)
_MARK[list(b",.!?;:)(#*$%&|<>-/\"[]{}=+@~^_")] = True


def _odd_spaces(buf: np.ndarray) -> np.ndarray:
    """Where white space begins that is not ASCII."""
    if len(buf) < 3:
        return np.zeros(len(buf), bool)
    a, b, c = buf, np.append(buf[1:], 0), np.append(buf[2:], [0, 0])
    out = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    out |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    out |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    out |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    return out | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a >= 0x1C) & (a <= 0x1F))


def piece_starts(buf: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Byte positions where a text may be cut without changing its pre-tokens.

    The byte-level pre-tokenizer takes letters, digits or other marks with one space before
    them; white space that has text on both sides and is one character long; so a cut is
    safe at such a space, around such a line break, and between a letter and a mark.
    """
    n = len(buf)
    space = _SPACE[buf]
    border = np.zeros(n + 1, bool)
    border[rows] = True
    before = np.ones(n, bool)  # no text before
    before[1:] = space[:-1]
    before |= border[:-1]
    after = np.ones(n, bool)
    after[:-1] = space[1:]
    after |= border[1:]
    alone = space & ~before & ~after
    cut = alone & ((buf == 0x20) | (buf == 0x0A))
    line = np.flatnonzero(alone & (buf == 0x0A))
    cut[line + 1] = True
    letter = _LETTER[buf]
    letter[1:] |= (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7) & (buf[1:] >= 0x80)
    cut[1:] |= letter[:-1] & _MARK[buf[1:]]
    cut |= border[:-1]
    return np.flatnonzero(cut)


def may_cut(definition: dict) -> bool:
    """Whether a tokenizer encodes the pieces of ``piece_starts`` one by one as it does the whole text:
    a byte-level BPE with the pre-tokenizer's own pattern and nothing before it."""
    before, model = definition.get("pre_tokenizer") or {}, definition.get("model") or {}
    byte_level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    return not definition.get("normalizer") and bool(byte_level) and model.get("type") == "BPE" and not model.get("dropout")


class Encoder:
    """Ids of whole texts by the tokenizers library, which sees each distinct piece of text once.

    Texts are cut into pieces where that can't change the result; a text with an added token of
    the tokenizer or unusual white space, and any text of a tokenizer that is not of the kind
    (``may_cut``), is encoded whole.  The ids of pieces are remembered, up to CACHE pieces.
    A piece is known by its bytes and nothing less: short ones are found by an
    open-addressing table of arrays, longer ones in a dict.
    """

    def __init__(self, definition: str, end: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        known = json.loads(definition)
        self.cuts = may_cut(known)
        added = [re.escape(t["content"].encode()) for t in known.get("added_tokens") or [] if t["content"]]
        self.added = re.compile(b"|".join(added)) if added else None
        highest = max(end, *self.tokenizer.get_vocab(with_added_tokens=True).values())
        self.dtype = np.dtype("<u2" if highest < 1 << 16 else "<u4")
        self._empty()

    def _empty(self) -> None:
        slots = 1 << (CACHE * 2 - 1).bit_length()
        self.mask = U64(slots - 1)
        self.slot_entry = np.full(slots, -1, np.int32)
        self.long: dict[bytes, int] = {}
        self.used = self.filled = 0
        self.one, self.two, self.size = np.zeros(CACHE + 1, U64), np.zeros(CACHE + 1, U64), np.zeros(CACHE + 1, np.int8)
        self.start, self.length = np.zeros(CACHE + 1, np.int32), np.zeros(CACHE + 1, np.int32)
        self.flat = np.zeros(4 * CACHE, self.dtype)

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _find(self, h: np.ndarray, one: np.ndarray, two: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The entry of each short piece, or -1."""
        out = np.full(len(h), -1, np.int32)
        todo, slot = np.arange(len(h)), (h & self.mask).astype(np.int64)
        while len(todo):
            entry = self.slot_entry[slot]
            taken = entry >= 0
            same = taken & (self.one[entry] == one[todo]) & (self.two[entry] == two[todo]) & (self.size[entry] == size[todo])
            out[todo[same]] = entry[same]
            on = taken & ~same
            todo, slot = todo[on], (slot[on] + 1) & int(self.mask)
        return out

    def _remember(self, ids: list[np.ndarray]) -> np.ndarray:
        """The new entries of pieces with these ids."""
        size = np.array([len(x) for x in ids], np.int64)
        total = int(size.sum())
        while self.filled + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), self.dtype)])
        entry = np.arange(self.used, self.used + len(ids), dtype=np.int32)
        self.start[entry] = self.filled + np.cumsum(size) - size
        self.length[entry] = size
        if total:
            self.flat[self.filled : self.filled + total] = np.concatenate(ids)
        self.used, self.filled = self.used + len(ids), self.filled + total
        return entry

    def _add(self, h: np.ndarray, one: np.ndarray, two: np.ndarray, size: np.ndarray, ids: list[np.ndarray]) -> None:
        """New distinct short pieces."""
        entry = self._remember(ids)
        self.one[entry], self.two[entry], self.size[entry] = one, two, size
        todo, slot = np.arange(len(h)), (h & self.mask).astype(np.int64)
        while len(todo):
            free = self.slot_entry[slot] < 0
            _, first = np.unique(slot, return_index=True)
            take = np.zeros(len(todo), bool)
            take[first] = True
            take &= free
            self.slot_entry[slot[take]] = entry[todo[take]]
            on = ~take
            todo, slot = todo[on], np.where(free[on], slot[on], (slot[on] + 1) & int(self.mask))

    def _entries(self, buf: np.ndarray, data: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray | None:
        """The entry of each piece; none if they are more than the cache holds."""
        eight, short = kernel.lanes(buf), np.flatnonzero(size <= SHORT)
        a, n = at[short], size[short]
        one = eight[a] & kernel._FIRST[np.minimum(n, 8)]
        two = eight[np.minimum(a + 8, len(buf))] & kernel._FIRST[np.clip(n - 8, 0, 8)]
        h = kernel.mix(one ^ kernel.mix(two ^ n.astype(U64)))
        long = np.flatnonzero(size > SHORT)
        names = [data[x : x + k] for x, k in zip(at[long].tolist(), size[long].tolist(), strict=True)]
        for _ in range(2):
            entry = np.empty(len(at), np.int32)
            entry[short] = found = self._find(h, one, two, n)
            missing = np.flatnonzero(found < 0)
            order = missing[np.lexsort((n[missing], two[missing], one[missing]))]
            new = np.ones(len(order), bool)
            new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]) | (n[order][1:] != n[order][:-1])
            fresh = order[new]
            unseen = [x for x in dict.fromkeys(names) if x not in self.long]
            if self.used + len(fresh) + len(unseen) <= CACHE:
                break
            if not self.used:
                return None
            self._empty()
        if len(fresh):
            ids = self.plain([data[x : x + k].decode() for x, k in zip(a[fresh].tolist(), n[fresh].tolist(), strict=True)])
            self._add(h[fresh], one[fresh], two[fresh], n[fresh], ids)
            entry[short[missing]] = self._find(h[missing], one[missing], two[missing], n[missing])
        if unseen:
            self.long.update(zip(unseen, self._remember(self.plain([x.decode() for x in unseen])).tolist(), strict=True))
        entry[long] = [self.long[x] for x in names]
        return entry

    def encode(self, buf: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, rows' bounds in them) for rows of one byte buffer."""
        n_rows = len(rows) - 1
        if not len(buf):
            return np.zeros(0, self.dtype), np.zeros(n_rows + 1, np.int64)
        data = buf.tobytes()
        texts = lambda of: [data[rows[i] : rows[i + 1]].decode() for i in of]
        if not self.cuts:
            return self._rows(texts(range(n_rows)))
        if self.filled > CACHE_IDS:
            self._empty()
        odd = kernel.row_sums(_odd_spaces(buf), rows) > 0
        for m in self.added.finditer(data) if self.added else ():
            odd[np.searchsorted(rows, [m.start(), m.end() - 1], "right") - 1] = True
        at = piece_starts(buf, rows)
        size = np.diff(np.append(at, len(buf)))
        own = np.searchsorted(at, rows)  # pieces by row
        if odd.any():
            keep = ~np.repeat(odd, np.diff(own))
            at, size = at[keep], size[keep]
            own = np.concatenate(([0], np.cumsum(np.where(odd, 0, np.diff(own)))))
        entry = self._entries(buf, data, at, size)
        if entry is None:
            return self._rows(texts(range(n_rows)))
        count = self.length[entry].astype(np.int64)
        ids = self.flat[spans(self.start[entry].astype(np.int64), count)]
        ends = np.concatenate(([0], np.cumsum(count)))[own]
        if not odd.any():
            return ids, ends
        done = [ids[ends[i] : ends[i + 1]] for i in range(n_rows)]
        where = np.flatnonzero(odd).tolist()
        for i, x in zip(where, self.plain(texts(where)), strict=True):
            done[i] = x
        return np.concatenate(done), np.concatenate(([0], np.cumsum([len(x) for x in done])))

    def _rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        done = self.plain(texts)
        return np.concatenate(done), np.concatenate(([0], np.cumsum([len(x) for x in done])))


_encoders: dict[str, Encoder] = {}


def encoder(definition: str, end: int) -> Encoder:
    """One a worker process, kept over tasks."""
    key = f"{hashlib.sha256(definition.encode()).hexdigest()}-{end}"
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition, end)
    return _encoders[key]


def _ended(enc: Encoder, column: pa.Array, end: int):
    """For runs of rows: (ids with the end id after each row, rows' bounds in them)."""
    for _, _, buf, rows in kernel.text_slices(column):
        ids, ends = enc.encode(buf, rows)
        yield np.insert(ids, ends[1:], end), ends + np.arange(len(ends))


def _ids(definition, end: int):
    def run(batches):
        enc = encoder(definition.value, end)
        for b in batches:
            out = [ids[a:c].tobytes() for ids, ends in _ended(enc, b.column(0), end) for a, c in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["ids"])

    return run


def _encode_blocks(definition, dictionary, end: int):
    def run(batches):
        import zstandard
        from pyspark import TaskContext

        enc = encoder(definition.value, end)
        name, data = dictionary.value
        press = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(data))
        part, block = TaskContext.get().partitionId(), 0
        ids, counts, frames, held = [], [], [], 0

        def flush():
            nonlocal ids, counts, frames, held, block
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames]))).astype("<u8")
            row = (part, block, name, min(ids), max(ids), len(ids), int(sum(counts)), blob(np.array(ids, "<i8")), blob(np.array(counts, "<u4")), blob(offsets), b"".join(frames))
            ids, counts, frames, held, block = [], [], [], 0, block + 1
            return table(_BLOCK_SCHEMA, [row])

        for b in batches:
            names = [_NULL_ID if x is None else x for x in b.column(0).to_pylist()]
            at = 0
            for flat, ends in _ended(enc, b.column(1), end):
                for a, c in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    ids.append(names[at])
                    counts.append(c - a)
                    frames.append(press.compress(flat[a:c].tobytes()))
                    held += len(frames[-1])
                    at += 1
                    if held >= BLOCK_BYTES:
                        yield flush()
        if ids:
            yield flush()

    return run


def _sample(docs: DataFrame) -> DataFrame:
    """The SAMPLE_DOCS documents with the lowest hashes."""
    key = F.xxhash64("doc_id", F.length("text"), F.substring("text", 1, 64))
    return lowest(docs.where(F.length("text").between(1, SAMPLE_CHARS)), key, SAMPLE_DOCS, "doc_id", "text")


def train_dictionary(samples: list[bytes], width: int) -> tuple[bytes, str]:
    """(dictionary, kind) from serialized id arrays: trained, or the sample's own bytes if there is too little to train on."""
    import zstandard

    raw = b"".join(samples)[-DICTIONARY_BYTES:].rjust(16 * width, b"\0")
    if len(samples) < TRAIN_DOCS or sum(map(len, samples)) < TRAIN_BYTES:
        return raw, "raw"
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes(), "trained"
    except zstandard.ZstdError:  # the trainer refuses samples that are nearly all alike
        return raw, "raw"


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str | None = None, end: int = END_ID) -> None:
    """Write (doc_id, text) rows to ``path`` in ascending id order, null ids first; null texts are empty.

    Rows with the same id are in the order of a hash of their texts.  An empty table gives no
    blocks.  Other columns are not written, whatever their names.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path(TOKENIZER)
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    definition = spark.sparkContext.broadcast(text)  # a tokenizer's definition: a few MB
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    width = Encoder(text, end).dtype.itemsize
    samples = [bytes(r[0]) for r in _sample(docs).select("text").mapInArrow(_ids(definition, end), "ids binary").collect()]
    data, kind = train_dictionary(samples, width)
    name = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(name, data, width, kind)], "hash string, bytes binary, width int, kind string").coalesce(1).write.parquet(f"{path}/dictionary")
    dictionary = spark.sparkContext.broadcast((name, data))
    # an id that many rows have is dealt further, by the text and the place it was read
    docs = docs.withColumn("again", F.xxhash64("text")).withColumn("place", F.spark_partition_id())
    parts = max(2 * partitions(spark), -(-size // PART_BYTES))
    docs = docs.repartitionByRange(parts, "doc_id", "again", "place").sortWithinPartitions("doc_id", "again", "place").select("doc_id", "text")
    docs.mapInArrow(_encode_blocks(definition, dictionary, end), _BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def _decode(dictionary, width: int):
    def run(batches):
        import zstandard

        name, data = dictionary.value
        undo = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
        dtype = np.dtype(f"<u{width}")
        for b in batches:
            for r in range(b.num_rows):
                ids, counts, offsets, payload, start, dict_hash = (b.column(i)[r].as_py() for i in range(6))
                if dict_hash != name:
                    raise ValueError(f"block made with dictionary {dict_hash}, not {name}")
                ids, counts, offsets = np.frombuffer(ids, "<i8"), np.frombuffer(counts, "<u4").astype(np.int64), np.frombuffer(offsets, "<u8").astype(np.int64)
                view = memoryview(payload)
                crc = [zlib.crc32(np.frombuffer(undo.decompress(view[a:c]), dtype).astype("<u4")) for a, c in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                starts = start + np.cumsum(counts) - counts
                names = pa.array(ids, mask=ids == _NULL_ID)
                yield pa.RecordBatch.from_arrays([names, pa.array(starts), pa.array(counts), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def _dictionary(spark: SparkSession, path: str):
    name, data, width, _ = spark.read.parquet(f"{path}/dictionary").select("hash", "bytes", "width", "kind").first()
    return spark.sparkContext.broadcast((name, bytes(data))), width


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Each row written has its row, also those with one id or a null id; no blocks give no rows.
    """
    dictionary, width = _dictionary(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    parts = parts.select("part", (F.sum("part_tokens").over(Window.orderBy("part")) - F.col("part_tokens")).alias("part_start"))  # a row a file
    inside = Window.partitionBy("part").orderBy("block")
    starts = blocks.select("part", "block", (F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("block_start"))
    starts = starts.join(parts, "part").select("part", "block", (F.col("part_start") + F.col("block_start")).alias("start"))
    rows = blocks.join(starts, ["part", "block"]).select("doc_ids", "counts", "offsets", "payload", "start", "dict_hash")
    return rows.mapInArrow(_decode(dictionary, width), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _pick(dictionary, width: int, wanted: frozenset):
    def run(batches):
        import zstandard

        _, data = dictionary.value
        undo = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
        for b in batches:
            for ids, offsets, payload in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                ids, offsets = np.frombuffer(ids, "<i8"), np.frombuffer(offsets, "<u8")
                at = [i for i, x in enumerate(ids.tolist()) if x in wanted]
                got = [np.frombuffer(undo.decompress(payload[offsets[i] : offsets[i + 1]]), f"<u{width}").astype(np.int32) for i in at]
                names = pa.array([None if x == _NULL_ID else x for x in ids[at].tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([names, pa.array([g.tolist() for g in got], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def fetch_tokens(spark: SparkSession, path: str, doc_ids: list[int | None]) -> DataFrame:
    """(doc_id, ids) of a few documents; only blocks that may have them are read and only their frames decompressed.

    An id that several rows have gives several rows, one that none has gives none.
    """
    dictionary, width = _dictionary(spark, path)
    wanted = sorted({_NULL_ID if x is None else x for x in doc_ids})
    may = F.lit(False)
    for x in wanted:
        may = may | ((F.col("min_id") <= x) & (F.col("max_id") >= x))
    blocks = spark.read.parquet(f"{path}/blocks").where(may).select("doc_ids", "offsets", "payload")
    return blocks.mapInArrow(_pick(dictionary, width, frozenset(wanted)), "doc_id long, ids array<int>")


def token_store(docs: DataFrame, tokenizer_path: str | None = None, end: int = END_ID) -> DataFrame:
    """Write docs to a new folder under the shared scratch folder and read the files back.

    A row for each row of docs, as ``write_tokens`` and ``read_tokens`` say for nulls, ties and empty tables.
    """
    path = f"{scratch(docs.sparkSession)}/tokens-{uuid.uuid4().hex[:8]}"
    write_tokens(docs, path, tokenizer_path, end)
    return read_tokens(docs.sparkSession, path)


def op5_token_output(spark, sf_dir: str) -> DataFrame:
    """All documents as byte-level BPE ids, written and read back."""
    return token_store(spark.read.parquet(f"{sf_dir}/documents.parquet"))
