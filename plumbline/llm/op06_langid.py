"""Language identification by rank-order profiles.

A text's n-grams of one to three letters (lower-cased, with a word-edge mark) are ranked by frequency; the distance
to a language is the sum, over the text's most frequent n-grams, of how far each is out of place in that language's
profile. Profiles come from a bounded sample of labelled texts; prediction is one pass over all whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import key_crc, maybe_broadcast

#: n-grams in a profile, and labelled texts that each language's profile is learned from at most.
TOP = 300
MAX_PER_LANG = 1500
EDGE = 32
_BLOCK = 1 << 20


def _letters() -> np.ndarray:
    """Code point to lower-cased letter, or EDGE where it is no letter, for the basic plane; others keep a hash."""
    out = np.full(0x10000, EDGE, np.uint32)
    for c in range(0x10000):
        x = chr(c)
        if x.isalpha():
            out[c] = ord(x.lower()[0])
    return out


_table: list[np.ndarray] = []


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's distinct n-grams as codes, and their counts; whole text, in blocks of bounded memory."""
    if not _table:
        _table.append(_letters())
    parts = []
    for i in range(0, len(text), _BLOCK):
        cp = np.frombuffer(text[max(0, i - 2) : i + _BLOCK].encode("utf-32-le", "replace"), np.uint32)
        if cp.max(initial=0) > 0xFFFF:
            low = np.where(cp <= 0xFFFF, _table[0][np.minimum(cp, 0xFFFF)], EDGE)
            far = np.flatnonzero(cp > 0xFFFF)
            low[far] = [ord(chr(c).lower()[0]) if chr(c).isalpha() else EDGE for c in cp[far]]
            cp = low
        else:
            cp = _table[0][cp]
        again = min(i, 2)  # code points that the last block had too
        x = np.concatenate((cp if i else np.concatenate(([EDGE], cp)), [EDGE] if i + _BLOCK >= len(text) else [])).astype(np.int64)
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != EDGE) | (x[:-1] != EDGE)  # runs of edges count as one
        x = x[keep]
        first = min(again, len(x))
        one, two = x[first:], x[max(0, first - 1) :]
        one = one[one != EDGE]
        two = (two[:-1] << 21) | two[1:]
        three = (x[:-2] << 42) | (x[1:-1] << 21) | x[2:]
        three = three[x[1:-1] != EDGE] if len(three) else three
        codes = np.concatenate((one, two, three))
        codes.sort()
        if len(codes):
            new = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            parts.append((codes[new], np.diff(np.append(new, len(codes)))))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)


def top_grams(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes in order; ties go by code."""
    if len(codes) > 4 * top:
        cut = np.partition(counts, len(counts) - top)[len(counts) - top]
        keep = counts >= cut
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))[:top]]


class Profiles:
    """The languages' ranked n-grams, for lookups of many n-grams at once."""

    def __init__(self, ranked: dict[str, np.ndarray]):
        self.langs = sorted(ranked)
        self.codes = np.unique(np.concatenate([ranked[k] for k in self.langs])) if ranked else np.empty(0, np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)
        for j, k in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, ranked[k]), j] = np.arange(len(ranked[k]))

    def judge(self, text: str | None) -> tuple[str, float]:
        """The nearest language (ties: the first by name) and 1 - its distance / the largest possible distance;
        ('und', 0.0) for texts that are null or have no letter, or where nothing was learned."""
        if not text or not self.langs:
            return "und", 0.0
        own = top_grams(*grams(text))
        if not len(own):
            return "und", 0.0
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        rank = np.where((self.codes[at] == own)[:, None], self.ranks[at], -1)
        far = np.where(rank < 0, TOP, np.abs(rank - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(far.argmin())
        return self.langs[best], float(1 - far[best] / (TOP * len(own)))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit_profiles(docs: DataFrame, learn_from, per_lang: int = MAX_PER_LANG, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles of every non-null language among the rows that learn_from admits, from per_lang texts of each,
    about, taken by a hash of the text; equal texts count once. Languages with null or letterless texts only are not learned."""
    known = docs.where(learn_from).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    # A share of the hash range for each language, by its number of different texts: about per_lang of them, without a
    # sort; of equal texts one stays, so copies neither crowd others out nor miss the share together.
    shares = known.groupBy("lang").agg(F.approx_count_distinct("th", 0.02).alias("n")).select("lang", (F.lit(float(per_lang)) / F.col("n")).alias("share"))
    chosen = known.join(maybe_broadcast(shares, 10_000), "lang").where((F.col("share") >= 1) | (F.pmod(F.xxhash64("th", F.lit(1)), F.lit(1 << 30)) < F.col("share") * (1 << 30)))
    chosen = chosen.dropDuplicates(["lang", "th"]).select("lang", "text")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, dict[int, int]] = {}
        for p in parts:
            for lang, text in zip(p["lang"], p["text"]):
                into = total.setdefault(lang, {})
                for c, k in zip(*(x.tolist() for x in grams(text))):
                    into[c] = into.get(c, 0) + k
        for lang, x in total.items():
            yield pd.DataFrame({"lang": lang, "code": np.array(list(x), np.int64), "k": np.array(list(x.values()), np.int64)})

    from pyspark.sql import Window

    sums = chosen.mapInPandas(count, "lang string, code long, k long").groupBy("lang", "code").agg(F.sum("k").alias("k"))
    order = Window.partitionBy("lang").orderBy(F.desc("k"), "code")
    rows = sums.withColumn("r", F.row_number().over(order)).where(F.col("r") <= TOP).collect()
    ranked: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["r"])):
        ranked.setdefault(r["lang"], []).append(r["code"])
    return Profiles({k: np.array(v, np.int64) for k, v in ranked.items()})


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score (0 to 1). Null, empty and letterless texts: 'und', 0.0. Columns of these names are
    replaced, all others stay; repeated rows are judged alike; an empty table gives no rows."""

    @F.pandas_udf("lang_pred string, score double")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            got = [profiles.judge(x) if isinstance(x, str) and has_letter(x) else ("und", 0.0) for x in s]
            yield pd.DataFrame(got, columns=["lang_pred", "score"])

    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), judge(F.col(text_col).cast("string")).alias("judged"))
    return rows.select("row.*", "judged.lang_pred", "judged.score")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(key_crc(F.col("doc_id"), 4) == 2, F.lit(False))
    profiles = fit_profiles(docs, F.coalesce(key_crc(F.col("doc_id"), 4) != 2, F.lit(False)))  # a null id has no remainder
    return identify(docs.select("doc_id", "text", held.alias("held_out")), profiles).select("doc_id", "held_out", "lang_pred", "score")
