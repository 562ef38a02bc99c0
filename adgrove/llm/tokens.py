"""Token ids of documents in files of directly addressable codes.

An id is cut into chunks, low bits first. Level 0 holds the first chunk of every id and a bitmap that says which ids go
on; level k + 1 holds the next chunk of those that do, in order. The place of an id's next chunk is the number of set
bits before it, which a directory of counts gives after one lookup and one short popcount. So any token is read from a
few bytes at computed places, with no block to decode.

File layout, little-endian: magic, header length, JSON header (documents, tokens, levels with the byte places of
their parts), document ids, NULL flags, token offsets of the documents, then for each level chunks, bitmap and directory.
"""

from __future__ import annotations

import json
import math
import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adgrove.llm.common import arrow_schema, map_arrow, table
from adgrove.llm.files import read_all, read_span, write_new
from adgrove.llm.words import steps, text_bytes
from adgrove.operators.scratch import Scratch

MAGIC = b"DACTOK01"
#: Bits of each level's chunk, multiples of 4; together they hold any unsigned 32-bit id.
WIDTHS = (12, 4, 8, 8)
#: Bits of a bitmap that one directory entry covers.
BLOCK = 512
#: Bytes of text that one task encodes, about.
TASK = 48 << 20
#: Tokens after which a task starts a new file.
FILE = 4 << 20
#: Bytes of text encoded at once.
SLICE = 2 << 20
#: Distinct chunks of text a worker process remembers the ids of; the memory is emptied when it is full.
REMEMBER = 3 << 19


# Encoding of ids

STEP = 1 << 18


def pack(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits (a multiple of 4) one after the other, most significant bit first."""
    shifts = np.arange(width - 4, -1, -4, dtype=np.uint32)
    parts, odd = [], np.empty(0, np.uint8)
    for low in range(0, len(values), STEP):
        part = values[low: low + STEP].astype(np.uint32)
        quarters = np.concatenate([odd, ((part[:, None] >> shifts) & np.uint32(15)).astype(np.uint8).reshape(-1)])
        even = len(quarters) // 2 * 2
        parts.append(((quarters[:even:2] << 4) | quarters[1:even:2]).tobytes())
        odd = quarters[even:]
    parts.append((odd << 4).tobytes())
    return b"".join(parts)


def unpack(data: bytes, width: int, n: int) -> np.ndarray:
    """``n`` values of ``width`` bits as unsigned 32-bit integers."""
    out, raw, each = np.empty(n, np.uint32), np.frombuffer(data, np.uint8), width // 4
    for low in range(0, n, STEP):
        high = min(n, low + STEP)
        some = raw[low * each // 2: -(-high * each // 2)]
        quarters = np.empty(2 * len(some), np.uint8)
        quarters[::2], quarters[1::2] = some >> 4, some & 15
        quarters = quarters[: (high - low) * each].reshape(-1, each)
        value = quarters[:, 0].astype(np.uint32)
        for k in range(1, each):
            value = (value << np.uint32(4)) | quarters[:, k]
        out[low:high] = value
    return out


def dump(doc_ids: Sequence[int | None], counts: Sequence[int], ids: np.ndarray, widths: Sequence[int] = WIDTHS) -> bytes:
    """File bytes of documents whose ids follow each other in ``ids``."""
    if ids.size and int(ids.max()) >> sum(widths):
        raise ValueError(f"an id needs more than {sum(widths)} bits")
    parts: list[bytes] = []
    at = 0

    def place(data: bytes) -> tuple[int, int]:
        nonlocal at
        parts.append(data)
        at += len(data)
        return at - len(data), len(data)

    header = {"documents": len(doc_ids), "tokens": len(ids), "block": BLOCK}
    header["doc_ids"] = place(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    header["null_ids"] = place(np.packbits(np.array([d is None for d in doc_ids], bool)).tobytes())
    header["starts"] = place(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype("<i8").tobytes())
    rest, levels = ids.astype(np.uint32, copy=False), []
    for k, width in enumerate(widths):
        goes_on = rest >= (1 << width)
        level = {"width": width, "n": len(rest), "chunks": place(pack(rest, width))}
        last = not goes_on.any()
        if not last:
            bits = np.packbits(goes_on)
            in_block = np.add.reduceat(goes_on, np.arange(0, len(goes_on), BLOCK), dtype=np.int64)
            ranks = np.cumsum(in_block) - in_block
            level["bitmap"], level["ranks"] = place(bits.tobytes()), place(ranks.astype("<i8").tobytes())
        levels.append(level)
        if last:
            break
        rest = rest[goes_on] >> np.uint32(width)
    header["levels"] = levels
    head = json.dumps(header).encode()
    return b"".join([MAGIC, struct.pack("<q", len(head)), head, *parts])


class TokenFile:
    """Reader of one file; ``fetch(start, size)`` returns bytes of it."""

    def __init__(self, fetch: Callable[[int, int], bytes]):
        head = fetch(0, 16)
        if head[:8] != MAGIC:
            raise ValueError("not a token file")
        size = struct.unpack("<q", head[8:])[0]
        self.header = json.loads(fetch(16, size))
        self.fetch = lambda start, n: fetch(16 + size + start, n)
        self.tokens = self.header["tokens"]

    def _part(self, place: Sequence[int]) -> bytes:
        return self.fetch(*place)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Document ids and their token offsets, one more than documents."""
        h = self.header
        ids = np.frombuffer(self._part(h["doc_ids"]), "<i8")
        null = np.unpackbits(np.frombuffer(self._part(h["null_ids"]), np.uint8), count=h["documents"])
        return [None if n else int(i) for i, n in zip(ids, null)], np.frombuffer(self._part(h["starts"]), "<i8")

    def token(self, i: int) -> int:
        """Token ``i``, read from a few bytes of each level that it reaches."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = shift = 0
        for level in self.header["levels"]:
            width, first = level["width"], i * level["width"]
            span = self.fetch(level["chunks"][0] + first // 8, (first + width - 1) // 8 - first // 8 + 1)
            bits = int.from_bytes(span) >> (len(span) * 8 - first % 8 - width)
            value |= (bits & ((1 << width) - 1)) << shift
            if "bitmap" not in level:
                break
            block = i // BLOCK
            word = self.fetch(level["bitmap"][0] + block * BLOCK // 8, i // 8 - block * BLOCK // 8 + 1)
            if not word[-1] >> (7 - i % 8) & 1:
                break
            before = int.from_bytes(word) >> (8 - i % 8)
            i = struct.unpack("<q", self.fetch(level["ranks"][0] + 8 * block, 8))[0] + before.bit_count()
            shift += width
        return value

    def ids(self) -> np.ndarray:
        """All ids in order."""
        levels = self.header["levels"]
        value = np.empty(0, np.uint32)
        for k in range(len(levels) - 1, -1, -1):
            level = levels[k]
            low = unpack(self._part(level["chunks"]), level["width"], level["n"])
            if "bitmap" in level:
                more = np.unpackbits(np.frombuffer(self._part(level["bitmap"]), np.uint8), count=level["n"])
                low[np.flatnonzero(more)] |= value << np.uint32(level["width"])
            value = low
        return value


def open_file(uri: str, whole: bool = False) -> TokenFile:
    """File at a URI: read as one piece, or only where it is asked."""
    if whole:
        data = read_all(uri)
        return TokenFile(lambda start, n: data[start: start + n])
    return TokenFile(lambda start, n: read_span(uri, start, n))


# Encoding of texts

# Runs of Latin letters, each followed by ASCII signs (no apostrophe, which can begin a contraction), on one or more lines.
LATIN, SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
PLAIN = re.compile(rf"[{LATIN}]+[{SIGNS}]*(?:\n[{LATIN}]+[{SIGNS}]*)*")
#: What is a unit of the vocabulary's pattern of its own between letters.
BETWEEN = re.compile(rf"([{SIGNS}]+|\n)")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(spare)) for b in range(256)}


class Known(dict):
    """Numbers of keys by first use; ``new`` lists the keys that were added."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key: str | tuple[str] | None) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class Encoder:
    """Ids of whole texts by a tokenizers file with byte-level BPE, each distinct piece of text encoded once.

    Such a tokenizer never joins a space to what stands before it, so a text falls apart at each single space between
    two characters that are not white space, and the ids of the pieces follow each other. The vocabulary's pattern cuts
    pieces of Latin letters and ASCII signs in a known way; many of them go to the model in one call, cut beforehand.
    All other pieces, and texts with unusual white space, pass through the tokenizer as they are.

    With ``special``, the library's own default, the string of a special token in a text becomes that token's id; such
    texts pass through the tokenizer whole. Without it the string is ordinary text.
    """

    def __init__(self, definition: str, end: int | None = None, special: bool = True):
        # Tasks are the parallelism; threads of the library would each keep memory of their own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.plain = Tokenizer.from_str(definition)
        self.plain.encode_special_tokens = not special
        added = self.plain.get_added_tokens_decoder().values() if special else ()
        self.added = [t.content for t in added if t.content]
        letters = byte_letters()
        self.mapped = str.maketrans({chr(b): c for b, c in letters.items()})
        model = self.plain.model
        if hasattr(model, "_resize_cache"):
            model._resize_cache(0)  # units come once each, a cache of theirs only costs
        self.units = Tokenizer(model)
        self.units.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(letters[0], "removed"), pre_tokenizers.Split(letters[32], "merged_with_next")
        ])
        vocabulary = self.plain.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith(letters[32])]] = True
        self.end = b"" if end is None else np.array([end], "<u4").tobytes()
        self._forget()

    def _forget(self) -> None:
        """Pieces behind a space are kept under their text, those that begin a text in a tuple, the end as None."""
        self.known, self.flat = Known(), bytearray()
        self.begin, self.size = array("q"), array("q")
        self.known[None]
        self.known.new.clear()
        self._store(np.array([len(self.end) // 4]), self.end)

    def _store(self, sizes: np.ndarray, ids: bytes) -> None:
        """Ids of the next numbers, one after the other; a size of -1 is white space at an edge: texts are not cut there."""
        whole = np.maximum(sizes, 0)
        self.size.frombytes(sizes.tobytes())
        self.begin.frombytes((len(self.flat) // 4 + np.cumsum(whole) - whole).tobytes())
        self.flat += ids

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [
            np.array(e.ids, "<u4").tobytes() for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _letters(self, words: list[str]) -> tuple[np.ndarray, bytes]:
        """Number of ids of each word behind a space, and all ids; ``words`` match ``PLAIN``."""
        texts = []
        for low in range(0, len(words), 128):
            text = BETWEEN.sub("\0\\1\0", " " + " ".join(words[low: low + 128]))
            texts.append(text.encode().decode("latin-1").translate(self.mapped))
        made = self.units.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable([e.ids for e in made]), np.uint32)
        # A space stands at the start of a word and nowhere else.
        first = np.flatnonzero(self.opens[ids])
        return np.diff(np.append(first, len(ids))), ids.tobytes()

    def spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of a space and each word, and all ids, word after word; nothing is remembered."""
        at = [n for n, w in enumerate(words) if PLAIN.fullmatch(w)]
        rest = sorted(set(range(len(words))).difference(at))
        sizes, ids = self._letters([words[n] for n in at])
        made = self._plain([" " + words[n] for n in rest])
        order = np.array(at + rest, np.int64)
        found = np.concatenate([sizes, [len(i) // 4 for i in made]]).astype(np.int64)
        size, begin = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        size[order], begin[order] = found, np.cumsum(found) - found
        flat = np.frombuffer(ids + b"".join(made), "<u4")
        return size, flat[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(flat))]

    def _learn(self) -> None:
        """Ids of all new keys, in the order of their numbers."""
        new, plain = self.known.new, PLAIN.fullmatch
        at = [n for n, k in enumerate(new) if k.__class__ is str and plain(k)]
        other = sorted(set(range(len(new))).difference(at))
        edge = [n for n in other if (k := new[n]).__class__ is str and (not k or k[0].isspace() or k[-1].isspace())]
        other = sorted(set(other).difference(edge))
        made = self._plain([" " + k if (k := new[n]).__class__ is str else k[0] for n in other])
        # Plain words take the first numbers of this call.
        order = np.array(at + other + edge, np.int64)
        sizes, ids = self._letters([new[n] for n in at])
        sizes = np.concatenate([sizes, [len(i) // 4 for i in made], np.full(len(edge), -1)]).astype(np.int64)
        base = len(self.size)
        self._store(sizes, ids + b"".join(made))
        if len(edge) or len(other):
            self._reorder(base, order)
        new.clear()

    def _reorder(self, base: int, order: np.ndarray) -> None:
        """Entries from ``base`` on belong to the numbers ``base + order``."""
        for values in (self.size, self.begin):
            moved = np.empty(len(order), np.int64)
            moved[order] = np.frombuffer(values, np.int64)[base:]
            del values[base:]
            values.frombytes(moved.tobytes())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids one after the other; with ``end`` each text has it at its end."""
        if len(self.known) > REMEMBER or len(self.flat) > 32 * REMEMBER:
            self._forget()
        if not len(texts):
            return np.empty(0, np.int64), np.empty(0, np.uint32)
        texts = texts.fill_null("")
        cut = pc.split_pattern(texts, " ")
        first = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
        pieces = cut.flatten()
        heads = pieces.take(pa.array(first[:-1])).to_pylist()
        alike = pieces.dictionary_encode()
        lookup = self.known.__getitem__
        codes = np.fromiter(map(lookup, alike.dictionary.to_numpy(zero_copy_only=False)), np.int64)[alike.indices.to_numpy()]
        codes[first[:-1]] = np.fromiter(map(lookup, zip(heads)), np.int64, len(heads))
        # Code 0, the end, behind each text.
        codes = np.insert(codes, first[1:], 0)
        first += np.arange(len(first))
        self._learn()
        size = np.frombuffer(self.size, np.int64)[codes]
        begin = np.frombuffer(self.begin, np.int64)[codes]
        apart = np.diff(first) > 2
        whole = {r for r in np.flatnonzero(apart).tolist() if not heads[r] or heads[r][-1].isspace()}
        whole |= set((np.searchsorted(first, np.flatnonzero(size < 0), "right") - 1).tolist())
        whole = sorted(whole.union(*[pc.indices_nonzero(pc.match_substring(texts, t)).to_pylist() for t in self.added]))
        flat = np.frombuffer(self.flat, "<u4")
        if whole:
            # Texts that cannot be cut stand behind the known pieces for this call, as one piece each.
            base, extra = len(flat), self._plain(texts.take(pa.array(whole)).to_pylist())
            for row, ids in zip(whole, extra):
                size[first[row]: first[row + 1] - 1] = 0
                begin[first[row]], size[first[row]] = base, len(ids) // 4
                base += len(ids) // 4
            flat = np.concatenate([flat, np.frombuffer(b"".join(extra), "<u4")])
        ends = np.cumsum(size)
        # Places in ``flat`` fit 32 bits: its length is bounded.
        ids = flat[np.repeat((begin - (ends - size)).astype(np.int32), size) + np.arange(ends[-1], dtype=np.int32)]
        return np.diff(np.concatenate([[0], ends])[first]), ids


_SHARED: dict[tuple, Encoder] = {}


def shared_encoder(definition: str, end: int | None = None, special: bool = True) -> Encoder:
    """The encoder of this worker process: tasks that follow each other in it share the words it has learned."""
    key = (definition, end, special)
    if key not in _SHARED:
        _SHARED.clear()
        _SHARED[key] = Encoder(definition, end, special)
    return _SHARED[key]


FILES = "path string, part bigint, documents bigint, tokens bigint"


def write_tokens(
    docs: DataFrame, folder: str, definition: str, scratch: Scratch, end: int = 0, task: int = TASK, file: int = FILE
) -> DataFrame:
    """Token files of (doc_id, text) rows in ascending id order; one row (path, part, documents, tokens, base) a file.

    ``definition`` is the JSON of a tokenizers file with byte-level BPE. Every document ends with id ``end``; a NULL
    or empty text is that id alone. NULL ids come first; rows with equal ids are ordered by text. Rows are dealt out by
    id ranges of about ``task`` bytes of text; a file holds about ``file`` tokens (whole documents) of one range, and
    ``base`` is the number of tokens in all files before it.
    """
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    ordered = docs.repartitionByRange(max(1, math.ceil(size / task)), "doc_id").sortWithinPartitions("doc_id", "text")
    numbered = ordered.withColumn("part", F.spark_partition_id())
    schema = arrow_schema(FILES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, doc_ids, counts, ids, part, number = shared_encoder(definition, end), [], [], bytearray(), 0, 0

        def flush() -> pa.RecordBatch:
            data = dump(doc_ids, counts, np.frombuffer(ids, "<u4"))
            path = write_new(folder, f"tokens-{part:06d}-{number:04d}", ".dac", data)
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([(part << 24) + number]), pa.array([len(doc_ids)]), pa.array([len(ids) // 4])],
                schema=schema,
            )

        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for low, high in steps(offsets, SLICE):
                some = batch.slice(low, high - low)
                part = some.column("part")[0].as_py()
                doc_ids += some.column("doc_id").to_pylist()
                n, made = encoder.encode(some.column("text"))
                counts += n.tolist()
                ids += made.data
                if len(ids) >= 4 * file:
                    yield flush()
                    doc_ids, counts, ids, number = [], [], bytearray(), number + 1
        if doc_ids:
            yield flush()

    files, _ = scratch.cut(numbered.mapInArrow(run, FILES))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _documents() -> object:
    schema = arrow_schema(DOCUMENTS)

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
            f = open_file(path, whole=True)
            doc_ids, starts = f.documents()
            ids = memoryview(f.ids().astype("<u4")).cast("B")
            crcs = [zlib.crc32(ids[4 * a: 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(starts[:-1] + base), pa.array(np.diff(starts)),
                 pa.array(crcs, pa.int64())], schema=schema,
            )

    return step


def read_documents(files: DataFrame) -> DataFrame:
    """Place, length and checksum of every document, decoded from the files; one task a file."""
    return map_arrow(files.select("path", "base").repartition(max(1, files.count()), "path"), _documents, DOCUMENTS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into token files and back."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    scratch = Scratch(spark)
    return read_documents(write_tokens(table(spark, sf_dir, "documents"), f"{scratch.folder}/tokens", definition, scratch))
