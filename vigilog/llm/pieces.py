"""SentencePiece encoding and decoding through a table of distinct marked words.

The normalised text is cut before every white-space marker that follows another
character. Where no piece of the vocabulary holds a marker after another character,
no merge can cross such a cut, so the ids of a text are those of its marked words in
order: a table from marked word to ids is enough, and the ids of a text are put together by position.

``word_table`` builds that table on Spark: each task gives its distinct words, a shuffle brings equal ones together, and
each word of several tasks is segmented once. Word occurrences are never shuffled. ``encode`` takes the table along with
the tasks: at most SHARED_WORDS words, those that most tasks hold. Words of one task only are segmented by that task, into a
table of its own, as are words beyond the bound, and all words where no table is given.

Nulls: a null text is empty; an empty text has no id. Very long texts are cut into marked words like others, and words
too long for the table are segmented each time. Ties among merges are the model's to settle. Repeated rows get equal
ids. An empty table gives no row, and an empty table of words. Input columns named like the added ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from vigilog.llm import common
from vigilog.sources.lake import materialise, scratch_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
# A task's table is started anew beyond this many words, and longer words aren't kept.
TABLE_WORDS = 400_000
TABLE_CHARS = 64
# Words of the table that is sent to all tasks: with TABLE_CHARS its size is bounded.
SHARED_WORDS = 400_000

COLUMNS = StructType([StructField("ids", ArrayType(IntegerType(), False), False), StructField("decoded", StringType(), False)])


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes as the library does, segmenting each marked word once while it is kept."""

    def __init__(self, model: bytes, table_words: int = TABLE_WORDS, shared: dict[str, bytes] | None = None):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.shared = shared or {}
        self.table: dict[str, bytes] = dict(self.shared)
        self.table_words = table_words
        self.mark = self.pieces.piece_to_id(MARK)
        self.cut = re.compile(f"{MARK}({MARK}*[^{MARK}]*)") if self._can_cut() else None

    def _can_cut(self) -> bool:
        """Whether words are independent: no piece crosses a marker, the text is only
        marked by normalisation, and a marker alone is a piece."""
        crossing = re.compile(f"[^{MARK}]{MARK}")
        crosses = any(crossing.search(self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size()))
        probe = " a  \téﬁ "
        plain = self.pieces.normalize(probe) == MARK + probe.replace(" ", MARK)
        return plain and not crosses and not self.pieces.is_unknown(self.mark)

    def _words(self, marked: str) -> list[str]:
        """The marked words of a normalised text, each without its first marker."""
        if MARK * 2 in marked or marked.endswith(MARK):
            return self.cut.findall(marked)
        return marked.split(MARK)[1:]

    def words(self, texts: list[str]) -> list[list[str]]:
        """The marked words of each text; none where words depend on each other."""
        return [self._words(t) for t in self.pieces.normalize(texts)] if self.cut is not None else [[] for _ in texts]

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids of words as int32 bytes. The library puts the first marker back itself,
        but not before an empty text."""
        found = self.pieces.encode(words, num_threads=1)
        flat, offsets = flatten([ids or [self.mark] for ids in found])
        whole, ends = flat.tobytes(), (offsets * flat.itemsize).tolist()
        return [whole[start:end] for start, end in zip(ends, ends[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One int32 array of ids per text."""
        if self.cut is None:
            return [np.array(ids, dtype=np.int32) for ids in self.pieces.encode(texts, num_threads=1)]
        cut = self.words(texts)
        if len(self.table) > len(self.shared) + self.table_words:
            self.table = dict(self.shared)
        missing = list(set().union(*cut).difference(self.table))
        self.table.update(zip(missing, self.segment(missing), strict=True))
        out = [np.frombuffer(b"".join(map(self.table.__getitem__, words)), dtype=np.int32) for words in cut]
        for word in missing:
            if len(word) > TABLE_CHARS:
                del self.table[word]
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.pieces.decode([one.tolist() for one in ids], num_threads=1) if ids else []


def flatten(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The values of lists in one array, and where each list begins and ends."""
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    return np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(offsets[-1])), offsets


@lru_cache(maxsize=1)
def encoder(model: bytes, sent: Broadcast | None = None) -> Encoder:
    """One encoder per Python worker, kept from task to task."""
    if sent is None:
        return Encoder(model)
    words, ids = sent.value
    return Encoder(model, shared=dict(zip(words.to_pylist(), ids.to_pylist(), strict=True)))


def _distinct_words(batches: Iterator[pa.RecordBatch], proto: bytes) -> Iterator[pa.RecordBatch]:
    """The words of a task, each once for every TABLE_WORDS words it holds."""
    own, seen = encoder(proto), set()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w for w in seen if len(w) <= TABLE_CHARS], pa.string())], names=["word"])

    for batch in common.slices(batches):
        for _, block in common.text_blocks(batch.column(0).to_pylist()):
            seen.update(chain.from_iterable(own.words(block)))
            if len(seen) > TABLE_WORDS:
                yield out()
                seen.clear()
    yield out()


def word_table(docs: DataFrame, model: str | None = None, text: str = "text", most: int = SHARED_WORDS) -> DataFrame:
    """(word, ids) of the distinct marked words that several tasks hold; ids as int32 bytes.

    Where these are more than ``most``, those stay that more tasks hold; words of equally many tasks stay or
    go together. Words of over TABLE_CHARS characters aren't in it.
    """
    spark = docs.sparkSession
    common.ship_code(spark)
    proto = Path(model or model_path()).read_bytes()
    held = docs.select(F.col(text)).mapInArrow(lambda batches: _distinct_words(batches, proto), "word string")
    held = materialise(held.groupBy("word").agg(F.count(F.lit(1)).alias("tasks")), scratch_path(spark, "words"))
    total, fewest = 0, None
    # As many rows as there are tasks at most.
    for tasks, words in held.where(F.col("tasks") > 1).groupBy("tasks").count().orderBy(F.desc("tasks")).collect():
        total += words
        if total > most:
            break
        fewest = tasks
    chosen = held.where(F.col("tasks") >= F.lit(fewest)).select("word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = encoder(proto).segment(batch.column(0).to_pylist()) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["word", "ids"])

    return chosen.mapInArrow(run, "word string, ids binary")


def id_lists(ids: list[np.ndarray]) -> pa.Array:
    sizes = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids))
    offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def encode(docs: DataFrame, model: str | None = None, text: str = "text", keep: list[str] | None = None, words: DataFrame | None = None) -> DataFrame:
    """Add ``ids`` (array of int, no begin or end ids) and ``decoded`` to every row.

    A null text counts as empty: no ids, decoded to the empty text. Input columns named
    like the added ones are replaced. ``model`` is a path the driver can read; the file
    (half a megabyte here) travels with the tasks, and so does ``words``, a ``word_table`` of the same
    model; without it each task fills a table of its own.
    """
    proto = Path(model or model_path()).read_bytes()
    sent = None
    if words is not None:
        table = words.toArrow().combine_chunks()
        sent = docs.sparkSession.sparkContext.broadcast((table.column("word"), table.column("ids")))

    def compute(values: dict[str, list]) -> list[pa.Array]:
        ids, decoded, own = [], [], encoder(proto, sent)
        for _, block in common.text_blocks(values[text]):
            found = own.encode(block)
            decoded += own.decode(found)
            ids.append(id_lists(found))
        return [pa.concat_arrays(ids) if ids else pa.array([], pa.list_(pa.int32())), pa.array(decoded, pa.string())]

    return common.add_columns(docs, [text], COLUMNS, compute, keep)


def digests(encoded: DataFrame) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(encode(docs, words=word_table(docs)))
