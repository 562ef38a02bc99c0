"""Language of a text by compression: the language whose dictionary makes it smallest."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adgrove.llm.common import MOST_GROUPS, bounded_sample, id_crc, map_rows, table

#: Training documents taken of each language.
SAMPLE = 400
#: Bytes of raw content in each dictionary.
CONTENT = 100 << 10
#: Bytes that are compressed at a time: short enough that a long text does not become its own dictionary.
CHUNK = 4096
LEVEL = 6
#: Share of the smallest size by which the next one must be larger for a prediction to be accepted.
MARGIN = 0.01
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")
GAP = regex.compile(r"[^\p{L}\p{M}]+")


def normal(text: str) -> bytes:
    """Letters in lower case with one space between words: capitals, digits and signs say nothing here."""
    return f" {GAP.sub(' ', text.lower()).strip()} ".encode()


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """Raw-content dictionary of each language, the most frequent first, from a bounded sample of at most ``SAMPLE`` rows a language.

    Rows with NULL language, NULL text or a text without letters teach nothing. A language's texts are dealt out in
    equal pieces until its content is full, so one long text cannot fill it alone. Of more than ``MOST_GROUPS`` languages
    the most frequent are learned, ties to the first name: each costs a dictionary in every task.
    """
    usable = labelled.select(key, text, lang).where(F.col(text).rlike(r"\p{L}") & F.col(lang).isNotNull())
    counts = usable.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(MOST_GROUPS).collect()
    common = {r[lang]: r["count"] for r in counts}
    usable = usable.where(F.col(lang).isin(list(common)))
    by_lang: dict[str, list[tuple[int, bytes]]] = {}
    for row in bounded_sample(usable, lang, key, SAMPLE).toLocalIterator():
        by_lang.setdefault(row[lang], []).append((row[key] if row[key] is not None else -1, normal(row[text])))
    content = {}
    for name, texts in by_lang.items():
        texts = [t for _, t in sorted(texts)]
        share = CONTENT // len(texts)
        spare = CONTENT - sum(min(len(t), share) for t in texts)
        parts = []
        for t in texts:
            more = min(max(0, len(t) - share), spare)
            spare -= more
            parts.append(t[: share + more])
        content[name] = b"".join(parts)
    return {name: content[name] for name in sorted(content, key=lambda n: (-common[n], n))}


def predict(
    df: DataFrame, content: dict[str, bytes], keep: Sequence[str] = ("doc_id",), text: str = "text",
    margin: float = MARGIN,
) -> DataFrame:
    """Columns ``keep``, ``lang_pred``, ``score`` and ``accepted``: the language that gives the fewest bytes.

    Whole texts are compressed, ``CHUNK`` bytes at a time, once per language. ``score`` grows from 0 with the lead
    over the second language in bytes and in share of the size. ``accepted`` is false where the lead is below
    ``margin`` of the size: a caller that wants to reject narrow results takes ``und`` there. A text that is NULL or
    has no letter is ``und`` with score 0, and so is every text if no language was learned. Equal sizes go to the
    first name, which ``learn`` makes the most frequent. Every row is judged on its own, so repeated rows and ids repeat their result.
    """
    names = list(content)

    def make():
        tools = []
        for data in content.values():
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            tools.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False
            ))

        def one(value: str | None) -> tuple[str, float, bool]:
            if not names or value is None or not LETTER.search(value):
                return UNKNOWN, 0.0, False
            data = normal(value)
            sizes = [0] * len(tools)
            for i in range(0, len(data), CHUNK):
                part = data[i: i + CHUNK]
                for k, tool in enumerate(tools):
                    sizes[k] += len(tool.compress(part))
            if len(sizes) == 1:
                return names[0], 1.0, True
            (best, first), (second, _) = sorted(zip(sizes, range(len(sizes))))[:2]
            lead = second - best
            return names[first], 1 - math.exp(-0.25 * lead - 20 * lead / best), lead > 0 and lead >= margin * best

        def derive(texts: pa.Array) -> list:
            found = [one(v.as_py()) for v in texts]
            return list(zip(*found)) if found else [[], [], []]

        return derive

    return map_rows(df, keep, [text], make, "lang_pred string, score double, accepted boolean")


def query(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those whose crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", id_crc("doc_id") % 3 == 1)
    return predict(docs, learn(docs.where("not held_out")), keep=["doc_id", "held_out"])
