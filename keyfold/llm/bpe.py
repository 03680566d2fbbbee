"""BPE encoding with a lexicon of frequent words, and decoding.

The most frequent words of the whole corpus are encoded once and compiled into a
minimal acyclic transducer. Its file goes to the shared folder, from where Spark
hands it to every executor; workers map it into memory. A word that is not in it
is merged exactly, so results do not depend on the lexicon.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..storage import new_path, store
from .lexicon import Lexicon, compile_lexicon
from .tokencount import batches_of
from .wordbpe import merger, model, normalise, pieces, words

ENCODED = StructType(
    [StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]
)
# Words in the lexicon: what bounds the file and the table that reaches the driver.
LEXICON_WORDS = 1 << 16
# A longer word is not frequent enough to earn its bytes.
LEXICON_BYTES = 64


def frequent_words(docs: DataFrame, text: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """The words between white space that are most frequent in all documents, in lower case.

    Counts fall into levels of about a twelfth of a doubling. The words returned are
    those of the highest levels that together have no more than ``most`` words, so
    what reaches the driver is bounded: the sizes of the levels, and those words.
    """
    word = F.explode(F.split(F.lower(F.col(text)), r"\s+")).alias("word")
    counts = docs.select(word).filter((F.col("word") != "") & (F.octet_length("word") <= LEXICON_BYTES)).groupBy("word").count()
    levels = store(counts.filter("count > 1").select("word", F.floor(12 * F.log2("count")).alias("level")), "words")
    enough, total = None, 0
    for row in sorted(levels.groupBy("level").count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        enough = row["level"]
    return [] if enough is None else [r["word"] for r in levels.filter(F.col("level") >= enough).collect()]


def build_lexicon(docs: DataFrame, path: str, text: str = "text", most: int = LEXICON_WORDS) -> str:
    """Compile the lexicon of ``docs`` and give it to the executors; returns its name for ``SparkFiles``."""
    found = list({w for word in frequent_words(docs, text, most) if (w := normalise(word)) and words(w) == [w]})
    ids, starts, sizes = Encoder(path, None).words(found)
    own = [i.tolist() for i in np.split(_gather(ids, starts, sizes), np.cumsum(sizes)[:-1])]
    return ship(docs.sparkSession, compile_lexicon(zip(found, own, strict=False)))


def ship(spark: SparkSession, content: bytes) -> str:
    """Write a file to the shared folder and hand it to the executors, also to later ones."""
    place = new_path(spark, "lexicon")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(place)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    spark.sparkContext.addFile(place)
    return place.rsplit("/", 1)[1]


def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` that start there and are so long, one after the other."""
    return pool[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


class Encoder:
    """Encodes the different words of a batch of texts together; nothing is kept between batches."""

    def __init__(self, path: str, lexicon: str | None):
        self.bpe = model(path)
        self.merger = merger(path)
        self.lexicon = Lexicon(SparkFiles.get(lexicon)) if lexicon else None

    def words(self, found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different words, and where each word's start and how many they are."""
        places = self.lexicon.find_all(found) if self.lexicon else np.full(len(found), -1)
        known = np.flatnonzero(places >= 0)
        sizes = np.zeros(len(found), np.int64)
        listed = np.empty(0, np.int32)
        if len(known):
            offsets = np.asarray(self.lexicon.offsets).astype(np.int64)
            starts = offsets[places[known]]
            sizes[known] = offsets[places[known] + 1] - starts
            listed = _gather(np.asarray(self.lexicon.ids), starts, sizes[known])
        unseen = np.flatnonzero(places < 0)
        cut = [pieces(found[i]) for i in unseen.tolist()]
        number: dict[str, int] = {}
        of_word = np.array([number.setdefault(p, len(number)) for parts in cut for p in parts], np.int64)
        ids, lengths = self.merger.merge(list(number))
        merged = _gather(ids, _starts(lengths)[of_word], lengths[of_word])
        whole = np.concatenate([[0], np.cumsum(lengths[of_word])])
        ends = np.cumsum([len(parts) for parts in cut], dtype=np.int64)
        sizes[unseen] = np.diff(whole[ends], prepend=0)
        starts = np.empty(len(found), np.int64)
        starts[known] = _starts(sizes[known])
        starts[unseen] = len(listed) + _starts(sizes[unseen])
        return np.concatenate([listed, merged]), starts, sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each text start, with the end of the last."""
        # Words by number; a special string's key is its id, so it is never taken for a word.
        number: dict[str | int, int] = {}
        used, ends = array("q"), [0]
        for text in texts:
            for segment, special in self.bpe.segments(text):
                for key in words(segment) if special is None else (special,):
                    used.append(number.setdefault(key, len(number)))
            ends.append(len(used))
        ids, starts, sizes = self.words([key for key in number if isinstance(key, str)])
        specials = [(i, key) for key, i in number.items() if isinstance(key, int)]
        if specials:
            at, values = zip(*specials, strict=True)
            before = np.array(at) - np.arange(len(at))
            starts = np.insert(starts, before, len(ids) + np.arange(len(at)))
            sizes = np.insert(sizes, before, 1)
            ids = np.concatenate([ids, np.array(values, ids.dtype)])
        own = np.frombuffer(used, np.int64) if used else np.empty(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes[own])])[ends]
        return _gather(ids, starts[own], sizes[own]).astype(np.int32, copy=False), offsets


@lru_cache(maxsize=2)
def _encoder(path: str, lexicon: str | None) -> Encoder:
    return Encoder(path, lexicon)


def encode_documents(
    docs: DataFrame,
    path: str,
    lexicon: str | None = None,
    keep: Sequence[str] | None = None,
    text: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` and, if asked for, ``decoded``.

    ``ids`` are those of the tokenizer file at ``path`` without special tokens
    added; special strings within a text become their ids. ``decoded`` is the text
    decoded from the ids. The file must be there on every worker. Null text counts
    as empty: no ids, an empty decoded text. Whole texts are encoded, however
    long; rows keep their number. ``keep`` names the columns to return, all unless
    given; columns of the new names are replaced.
    """
    made = ENCODED.names if decoded else ENCODED.names[:-1]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    # The text goes to the workers and back once, not also within the document.
    apart = text in kept and len(kept) > 1
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept if c != text or not apart]).alias("doc"), F.col(f"`{text}`").alias("text"))
    passed = rows.columns if apart else ["doc"]
    schema = StructType([*rows.select(*passed).schema, *[f for f in ENCODED if f.name in made]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, lexicon)
        for batch in batches:
            for start, end in batches_of(batch.column("text")):
                part = batch.slice(start, end - start)
                ids, offsets = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                columns = [*map(part.column, passed), pa.array(np.diff(offsets)), listed]
                if decoded:
                    columns.append(pa.array([encoder.bpe.decode(i) for i in listed.to_pylist()], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    given = [F.col("text").alias(c) if apart and c == text else F.col(f"doc.`{c}`") for c in kept]
    return rows.mapInArrow(encode, schema).select(*given, *made)


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids; null ids count as none."""
    kept = [c for c in encoded.columns if c != "decoded"]
    rows = encoded.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(ids).alias("ids"))
    schema = rows.select("row").schema.add("decoded", StringType())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in batches:
            texts = pa.array([bpe.decode(i or ()) for i in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), texts], names=schema.names)

    return rows.mapInArrow(decode, schema).select("row.*", "decoded")
