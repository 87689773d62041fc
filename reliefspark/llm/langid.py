"""Language identification by compression.

Each language has a raw-content Zstandard dictionary: passages drawn from all training texts of that language.
A document's letters, lower-cased, are cut into blocks of a fixed number of bytes, every block is compressed with
every dictionary, and the language whose sizes add up to least is chosen.  Blocks are
compressed on their own so that a long document is measured against the dictionaries
throughout and not against its own beginning.  The margin between the two least totals
gives the score; below a stated margin the answer is marked narrow.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import frugal, store, workspace
from .toxicity import held_out

#: Bytes of a language's dictionary and of all dictionaries together, at most (all are broadcast); bytes of a passage, about.
DICTIONARY_BYTES, ALL_BYTES, PASSAGE_BYTES = 110_000, 32_000_000, 600
#: Passages of a language that are drawn for its dictionary, at most; shorter ones only where others lack.
DRAWN, FULL_PASSAGE = 200, 200
BLOCK_BYTES = 1024
LEVEL = 6
#: Bits saved per byte of text, against the second best, below which an answer is narrow.
NARROW = 0.02


_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str) -> bytes:
    """The lower-cased letters, each run of anything else as one space."""
    return _NOT_LETTERS.sub(" ", text).lower().strip().encode("utf-8")


def passages(data: bytes) -> Iterator[bytes]:
    """data cut into pieces of about PASSAGE_BYTES, at spaces where there are any, never within a code point."""
    at = 0
    while len(data) - at > PASSAGE_BYTES:
        end = data.rfind(b" ", at + 1, at + PASSAGE_BYTES)
        if end < 0:
            end = at + PASSAGE_BYTES
            while data[end] & 0xC0 == 0x80:
                end -= 1
        yield data[at:end].strip()
        at = end
    yield data[at:].strip()


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, short, h, passage): each language's DRAWN distinct passages of smallest (short, h) in this task."""
    best: dict[str, list[tuple[int, int, bytes]]] = {}  # heaps, the largest first
    held: dict[str, set[int]] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            heap, mine = best.setdefault(lang, []), held.setdefault(lang, set())
            for p in passages(normal(text)):
                if not p:
                    continue
                h = int.from_bytes(hashlib.blake2b(p, digest_size=8).digest(), "little", signed=True)
                row = (-int(len(p) < FULL_PASSAGE), -h, p)
                if h in mine or (len(heap) >= DRAWN and row <= heap[0]):
                    continue
                mine.add(h)
                if len(heap) < DRAWN:
                    heapq.heappush(heap, row)
                else:
                    mine.discard(-heapq.heapreplace(heap, row)[1])
    for lang, heap in best.items():
        if heap:
            short, h, p = zip(*heap, strict=True)
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(heap)), pa.array([-x for x in short], pa.int32()), pa.array([-x for x in h], pa.int64()), pa.array(p, pa.binary())], ["lang", "short", "h", "passage"])


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries from docs (doc_id, text, lang): non-null languages, crc32(doc_id as text) mod 5 not 0.

    All texts are cut into passages, and a language's dictionary holds the DRAWN distinct passages of smallest
    hash, a bounded sample in which every part of every text has the same chance, copies count once and ties
    cannot be. Every language is learned; where there are so many that their dictionaries would exceed ALL_BYTES,
    each gets an equal, smaller share. A language whose texts have no letter is not learned.
    Columns but these three are ignored, rows of null id, text or language left out; of repeated rows one counts.
    An empty table gives no dictionary.
    """
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("lang", "text")
    drawn = usable.mapInArrow(frugal(_draw), "lang string, short int, h long, passage binary").dropDuplicates(["lang", "h"])
    # Ranked in parts first, so that no task ranks all tasks' draws of a language.
    order = [F.col("short"), F.col("h")]
    some = drawn.withColumn("k", F.row_number().over(Window.partitionBy("lang", F.pmod("h", F.lit(16))).orderBy(*order))).filter(F.col("k") <= DRAWN)
    top = some.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("k") <= DRAWN).select("lang", "k", "passage")
    top = store(top, workspace(docs.sparkSession, "langid"), "drawn")
    n = top.select("lang").distinct().count()
    share = min(DICTIONARY_BYTES, ALL_BYTES // max(1, n))
    by: dict[str, list[bytes]] = {}
    # At most ALL_BYTES and a passage a language come to the driver.
    for lang, _, p in sorted(map(tuple, top.filter(F.col("k") <= 1 + share // PASSAGE_BYTES).collect())):
        by.setdefault(lang, []).append(bytes(p))
    out = {}
    for lang, parts in by.items():
        whole = parts[0]
        for p in parts[1:]:
            if len(whole) + 1 + len(p) <= share:
                whole += b"\n" + p
        out[lang] = whole
    return out


class Compressor:
    def __init__(self, texts: dict[str, bytes]) -> None:
        import zstandard as z

        self.langs = sorted(texts)
        self.tools = []
        for lang in self.langs:
            d = z.ZstdCompressionDict(texts[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.tools.append(z.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, data: bytes) -> list[int]:
        parts = [data[k : k + BLOCK_BYTES] for k in range(0, len(data), BLOCK_BYTES)]
        if len(parts) > 1 and len(parts[-1]) < BLOCK_BYTES // 4:
            parts[-2:] = [parts[-2] + parts[-1]]
        return [sum(len(t.compress(p)) for p in parts) for t in self.tools]

    def classify(self, text: str) -> tuple[str, float, bool]:
        """(language, score, whether the margin is narrow); score: 0.5 at no margin, to 1."""
        data = normal(text)
        sizes = self.sizes(data)
        low = min(sizes)
        best = [k for k, s in enumerate(sizes) if s == low]
        if len(best) > 1:  # a tie, as of short texts: single words show finer differences
            words = data.split()
            fine = [sum(len(self.tools[k].compress(w)) for w in words) for k in best]
            best = [best[fine.index(min(fine))]]
        rest = min((s for k, s in enumerate(sizes) if k != best[0]), default=low + len(data))
        margin = 8 * (rest - low) / max(1, len(data))
        return self.langs[best[0]], 1 / (1 + math.exp(-min(50.0, 6 * margin))), margin < NARROW


def classify(docs: DataFrame, texts: dict[str, bytes]) -> DataFrame:
    """docs (doc_id, text, ...) with lang_pred, score and narrow for every row.

    A null or empty text and one without a letter is `und`, score 0, narrow; so is every text if no language
    was learned. Ties go to the language whose dictionary shortens the single words most, then to
    the first by name. Texts are read whole, however long; repeated rows get a row each, an empty table
    no rows. A column of docs with one of the result's names is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(texts)
    docs = docs.drop("lang_pred", "score", "narrow")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Compressor(shared.value)
        for batch in batches:
            rows = [tool.classify(t) if t is not None and tool.langs and any(map(str.isalpha, t)) else ("und", 0.0, True) for t in batch.column("text").to_pylist()]
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.bool_())], [*batch.schema.names, "lang_pred", "score", "narrow"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(frugal(run), f"{schema}, lang_pred string, score double, narrow boolean")
