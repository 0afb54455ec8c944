"""Language identification by compression.

Each language has a zstandard raw-content dictionary, made from a bounded, documented sample of labelled texts. A text is
compressed, block by block over its whole length, with every dictionary; the smallest total names the language. The gap
to the runner-up, per compressed byte, is the margin; narrow margins are rejected (column `rejected`).

Defined results: a null text, or one without a letter, has language `und`, score 0 and is rejected; without any labelled
text every language is `und`; ties go to the alphabetically first language; repeated rows each get a row; a null doc_id
is kept and its row is never used for learning; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, model, release

UNDETERMINED = "und"
LETTER = r"\p{L}"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalise(text: str) -> str:
    """Lower-cased words with single blanks: case, digits and marks tell no language here."""
    return f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "


def learn(labelled: DataFrame, docs_per_language: int = 400, chars_per_doc: int = 600) -> dict[str, bytes]:
    """language -> dictionary content, from rows of (doc_id, text, lang).

    Bounded sample: about docs_per_language documents of each language, chosen by a hash of doc_id, and of each
    chars_per_doc characters from a place that the same hash picks.
    """
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(LETTER))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, docs_per_language / n))]), F.col("lang"))
    unit = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(5)), 11) / F.lit(float(2**53))
    room = F.greatest(F.length("text") - chars_per_doc, F.lit(0))
    start = F.pmod(F.xxhash64("doc_id", F.lit(6)), room.cast("long") + 1).cast("int") + 1
    sample = labelled.filter(unit < share).select("doc_id", "lang", F.substring("text", start, F.lit(chars_per_doc)).alias("text"))
    parts: dict[str, list[str]] = {lang: [] for lang in counts}
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["doc_id"])):
        parts[r["lang"]].append(normalise(r["text"]))
    return {lang: "".join(x).encode() for lang, x in sorted(parts.items()) if x}


class Classifier:
    """A compressor for each language, with one setting for texts of any length. The window holds a whole dictionary and a block;
    the tables are sized to it, as each worker has them all."""

    def __init__(self, dictionaries: dict[str, bytes], block: int = 4096, level: int = 9):
        self.languages, self.block, self.tools = sorted(dictionaries), block, []
        for lang in self.languages:
            window = max(17, (len(dictionaries[lang]) + block).bit_length())
            settings = zstandard.ZstdCompressionParameters.from_level(level, window_log=window, hash_log=17, chain_log=17, write_content_size=False, write_checksum=False, write_dict_id=False)
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=settings)
            self.tools.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=d))

    def sizes(self, text: str) -> list[int]:
        data = normalise(text).encode("utf-8", "surrogatepass")
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.tools]

    def predict(self, text: str) -> tuple[str, float, float]:
        """Language, score in [0, 1] and margin (bytes that the runner-up takes more, as a share of its bytes)."""
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.languages[0], 1.0, 1.0
        second = min(s for i, s in enumerate(sizes) if i != best)
        rest = sum(math.exp(-min(60.0, (s - sizes[best]) * math.log(2))) for s in sizes)
        return self.languages[best], 1.0 / rest, (second - sizes[best]) / max(1, second)


def classifier(dictionaries: dict[str, bytes]):
    """A pandas UDF of a text: struct of lang_pred, score and margin."""
    key = ("languages", hash(tuple(sorted(dictionaries.items()))))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = model(key, lambda: Classifier(dictionaries))
        for texts in batches:
            rows = []
            for t in texts:
                usable = isinstance(t, str) and dictionaries and any(map(str.isalpha, t))
                rows.append(known.predict(t) if usable else (UNDETERMINED, 0.0, 0.0))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "margin"])
        release()

    return F.pandas_udf(run, "lang_pred string, score double, margin double")


def is_rejected(found: Column, narrow: float) -> Column:
    """Whether a verdict has no language, or a margin of at most `narrow`."""
    return (found["lang_pred"] == UNDETERMINED) | (found["margin"] <= narrow)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], narrow: float = 0.04) -> DataFrame:
    """(row, lang_pred, score, margin, rejected): row is a struct of the columns of docs, so that none can clash.

    `narrow` is the share of its bytes that the runner-up must take more. Clean texts of 30 bytes and more keep far above 0.04.
    """
    bound_batches(docs.sparkSession)
    found = docs.select(F.struct("*").alias("row"), classifier(dictionaries)(F.col("text").cast("string")).alias("found"))
    return found.select("row", "found.*", is_rejected(F.col("found"), narrow).alias("rejected"))


def held_out() -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
