"""Language identification by compression.

Each language has a raw-content dictionary of zstandard made of passages of its
documents. A text is coded with every dictionary; the language of the smallest code wins.

Defined results: null text, or text without a letter, is `und` with score 0. Equal sizes
go to the language first in alphabetical order. Without any labelled text all is `und`.
Repeated rows give repeated results; other columns of the input are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
#: Fractions, Roman numerals and the like are word characters to a pattern, but no letters.
_NUMBERS = {n: " " for n in range(0x110000) if chr(n).isnumeric() and not chr(n).isalpha()}
RESULT = "doc_id long, lang_pred string, score double, accepted boolean"


@dataclass(frozen=True)
class Settings:
    #: Sample the dictionaries are fitted on: texts of a language, passages of a text,
    #: characters of a passage. Passages are spread evenly over the text.
    texts: int = 192
    passages: int = 3
    passage_chars: int = 192
    #: Bytes coded at once. Every byte of a text is coded, piece by piece.
    piece_bytes: int = 2048
    level: int = 12
    #: Share of the smallest code by which the second must be larger, else not accepted.
    margin: float = 0.01


@dataclass
class Model:
    dictionaries: dict[str, bytes]
    settings: Settings = field(default_factory=Settings)

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "settings": self.settings}

    @cached_property
    def coders(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        made = []
        for name in sorted(self.dictionaries):
            content = zstandard.ZstdCompressionDict(self.dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=self.settings.level)
            made.append((name, zstandard.ZstdCompressor(dict_data=content, write_content_size=False, write_dict_id=False)))
        return made

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the margin is wide enough."""
        data = plain(text).encode()
        if not data or not self.coders:
            return UNKNOWN, 0.0, False
        step = self.settings.piece_bytes
        pieces = [data[i : i + step] for i in range(0, len(data), step)]
        sizes = np.array([sum(len(c.compress(p)) for p in pieces) for _, c in self.coders], dtype=float)
        best = int(sizes.argmin())
        # A softmax of the relative sizes: about 1 when all others are much larger.
        score = 1 / np.exp((sizes[best] - sizes) / sizes[best] / max(self.settings.margin, 1e-6)).sum()
        others = np.delete(sizes, best)
        wide = not len(others) or others.min() - sizes[best] >= self.settings.margin * sizes[best]
        return self.coders[best][0], float(score), bool(wide)


def plain(text: str | None) -> str:
    """The words of a text in lower case, one space between them."""
    lower = (text or "").lower()
    words = _LETTERS.findall(lower)
    if not "".join(words).isalpha():
        words = _LETTERS.findall(lower.translate(_NUMBERS))
    return " ".join(words)


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Dictionaries from `text` and `lang`. The texts of a language are those of lowest
    hash, each different text once, so copies do not fill a dictionary."""
    rows = docs.select("text", "lang", F.xxhash64("text").alias("_hash")).filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    lowest = Window.partitionBy("lang").orderBy("_hash")
    chosen = (
        rows.select("lang", "_hash").distinct()
        .withColumn("_n", F.row_number().over(lowest))
        .filter(F.col("_n") <= settings.texts)
        .drop("_n")
    )
    # Bounded: `texts` rows for each language.
    texts = rows.join(F.broadcast(chosen), ["lang", "_hash"]).select("lang", "_hash", *passages("text", settings))
    held: dict[str, dict[int, str]] = {}
    for row in texts.groupBy("lang", "_hash").agg(F.min("passage").alias("passage")).orderBy("lang", "_hash").collect():
        held.setdefault(row["lang"], {})[row["_hash"]] = row["passage"]
    return Model({lang: " ".join(map(plain, found.values())).encode() for lang, found in held.items()}, settings)


def passages(text: str, settings: Settings) -> list[Column]:
    """Evenly spread passages of a text, or all of a short one."""
    size, n = settings.passage_chars, settings.passages
    length = F.length(text)
    spread = [
        F.substring(text, (F.lit(i) * ((length - size) / max(1, n - 1))).cast("int") + 1, F.lit(size))
        for i in range(n)
    ]
    return [F.when(length <= size * n, F.col(text)).otherwise(F.concat_ws(" ", *spread)).alias("passage")]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and accepted of every row of `docs` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            languages, scores, accepted = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
                ["doc_id", "lang_pred", "score", "accepted"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, RESULT)
