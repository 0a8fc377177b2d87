"""Language ID by compression: the dictionary under which a text gets smallest names its language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_rows, place_of, rows_and, slices

#: Bounds of the learning sample, per language: texts, characters of a text, bytes of a dictionary.
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 1500
DICTIONARY_BYTES = 64 << 10
#: Languages that can be learned; more are an error.
MOST_LANGUAGES = 200
CHUNK = 1000
LEVEL = 3
#: Texts with a margin below ``UNSURE`` are encoded again with more effort.
STRONG_LEVEL = 12
UNSURE = 0.05
#: A text whose second-best size is less than this share above the best is rejected.
LEAST_MARGIN = 0.004
UNKNOWN = "und"


@dataclass(frozen=True)
class Languages:
    """A raw-content dictionary per language, the most frequent language first."""

    dictionaries: dict[str, bytes]


def normal(text: str) -> str:
    """Lower-case letters and single spaces: what is compressed and what dictionaries hold."""
    import regex

    return regex.sub(r"[^\p{L}\p{M}]+", " ", text.lower()).strip()


def learn(docs: DataFrame, key: str, text: str, lang: str) -> Languages:
    """Dictionaries from a bounded sample of the labelled rows.

    Rows with a NULL text or label are left out. Counts per label choose a hash threshold that lets
    about ``SAMPLE_TEXTS`` texts of each language through, whatever the size of the table; they are
    ordered by that hash, so the same table gives the same dictionaries. What reaches the driver is
    bounded by the parameters above.
    """
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = known.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages; learn them in several models")
    if not counts:
        return Languages({})
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.col(key).cast("string")), F.lit(1 << 30))
    share = [F.when(F.col(lang) == r[lang], F.lit(min(1.0, SAMPLE_TEXTS / r["count"]))) for r in counts]
    sample = (
        known.where(drawn < F.coalesce(*share, F.lit(0.0)) * F.lit(float(1 << 30)))
        .select(F.col(lang).alias("lang"), F.substring(F.col(text), 1, SAMPLE_CHARS).alias("text"), drawn.alias("drawn"))
        .orderBy("drawn", "text")
        .limit(2 * SAMPLE_TEXTS * len(counts))
        .collect()
    )
    dictionaries = {}
    for row in counts:
        texts = (normal(r["text"]) for r in sample if r["lang"] == row[lang])
        dictionaries[row[lang]] = " ".join(t for t in texts if t).encode()[:DICTIONARY_BYTES]
    return Languages({k: v for k, v in dictionaries.items() if v})


def classify(docs: DataFrame, key: str, text: str, model: Languages) -> DataFrame:
    """``key, lang_pred, score, accepted``; only the text decides.

    The whole text goes through every dictionary, in chunks of ``CHUNK`` bytes so that a dictionary
    counts as much at the end of a long text as at its start; the smallest sum names the language,
    ties go to the more frequent one. Narrow margins are decided at a higher level. ``score`` is ``1 - best / second`` scaled to 0..1 by
    ``tanh(8 x)``; with a single language it is 1. ``accepted`` is false for narrow margins.

    A NULL text, or one without a letter, is ``und`` with score 0 and not accepted; so is every text
    if nothing was learned. NULL and repeated keys stay; an empty table gives no rows; columns not
    named are ignored, whatever they are called.
    """

    found = judged(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", model)
    return found.select(F.col("row.key").alias(key), *NEW)


def accepted_rows(docs: DataFrame, text: str, model: Languages) -> DataFrame:
    """The rows of ``docs`` whose language is told with a clear margin, with all their columns."""
    return judged(docs, text, model).where("accepted").select("row.*")


def judged(docs: DataFrame, text: str, model: Languages) -> DataFrame:
    """``row, lang_pred, score, accepted``: each row of ``docs`` as one struct, so no name meets another."""

    def each(batches: Iterator) -> Iterator:
        import math

        import pyarrow as pa
        import pyarrow.compute as pc
        import zstandard

        def compressors(level: int) -> list:
            made = []
            for content in model.dictionaries.values():
                data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(level=level)
                made.append(zstandard.ZstdCompressor(
                    level=level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
                ).compress)
            return made

        names, fast, strong = list(model.dictionaries), compressors(LEVEL), compressors(STRONG_LEVEL)

        def smallest(chunks: list[bytes], encoders: list) -> tuple[int, float]:
            sizes = [(sum(len(squeeze(c)) for c in chunks), i) for i, squeeze in enumerate(encoders)]
            (best, i), *rest = sorted(sizes)
            return i, 1.0 - best / rest[0][0] if rest else 1.0

        def one(body: str | None) -> tuple[str, float, bool]:
            plain = normal(body) if body else ""
            if not plain or not names or not any(c.isalpha() for c in plain):
                return UNKNOWN, 0.0, False
            raw = plain.encode("utf-8", "replace")
            chunks = [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]
            i, margin = smallest(chunks, fast)
            if margin < UNSURE:
                i, margin = smallest(chunks, strong)
            return names[i], math.tanh(8.0 * margin), margin >= LEAST_MARGIN

        for batch in slices(batches):
            made = [one(body) for body in pc.struct_field(batch.column(0), at).to_pylist()]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            found = [pa.array([m[j] for m in made], kind) for j, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["row", *NEW])

    rows, at = as_rows(docs), place_of(docs, text)
    return rows.mapInArrow(each, rows_and(rows, "lang_pred string, score double, accepted boolean"))


NEW = ("lang_pred", "score", "accepted")


def held_out(key: str):
    """One row in five, never learned from: the checksum of the key's text decides."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))
