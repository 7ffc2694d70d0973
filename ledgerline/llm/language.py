"""Hierarchical language identification with linear support vector machines.

First the language family is told from hashed character n-grams by one machine per family, then
one-versus-one machines separate the languages inside that family by votes. The machines are fitted on a
bounded sample: at most ``per_language`` labelled texts of each language, chosen by a hash of the id
among all labelled rows. Every text is read whole, both in fitting and in prediction.

Defined results: a null text or a text without a letter is ``und`` with score 0; equal texts get equal
answers; without labelled rows every text is ``und``; with one language every text with a letter is that
language; repeated rows count as often as they occur; other columns are passed through untouched.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stash, text_function

DIMENSIONS = 2048
PER_LANGUAGE = 800
PIECE = 1 << 20
UNDETERMINED = "und"
# Language codes by family; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indo-aryan": "hi ur bn pa mr gu ne",
    "sinitic": "zh yue wuu",
    "semitic": "ar he am mt",
}


def family_of(language: str) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return next((family for family, codes in FAMILIES.items() if code in codes.split()), f"own:{code}")


def _letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def ngram_vector(text: str | None, letters: np.ndarray, size: int = DIMENSIONS) -> np.ndarray | None:
    """Square roots of hashed counts of 1- to 3-grams, of unit length; None without a letter."""
    counts = np.zeros(size, dtype=np.int64)
    shift, some = np.uint64(64 - int(size - 1).bit_length()), False
    whole = (text or "").lower()
    for at in range(0, len(whole), PIECE):
        codes = np.frombuffer(whole[at : at + PIECE].encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        is_letter = letters[np.minimum(codes, 0xFFFF).astype(np.int64)]
        for i in np.flatnonzero(codes > 0xFFFF):
            is_letter[i] = chr(int(codes[i])).isalpha()
        if not is_letter.any():
            continue
        some = True
        # One space stands for every run of other characters.
        kept = np.where(is_letter, codes, np.uint64(32))
        before = np.concatenate([[False], is_letter[:-1]])
        c = np.concatenate([[32], kept[is_letter | before], [32]]).astype(np.uint64)
        two = (c[:-1] << np.uint64(21)) | c[1:]
        three = (two[:-1] << np.uint64(21)) | c[2:]
        for grams in (c, two, three):
            counts += np.bincount(((grams * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64), minlength=size)
    if not some:
        return None
    root = np.sqrt(counts)
    return (root / np.linalg.norm(root)).astype(np.float32)


def _features(size: int):
    def features(batches):
        letters = _letter_table()
        for texts in batches:
            rows = [ngram_vector(t.as_py(), letters, size) for t in texts]
            yield pa.array([None if r is None else r for r in rows], type=pa.list_(pa.float32()))

    return text_function(features, "array<float>")


def fit_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 30) -> np.ndarray:
    """Weights and offset of a linear machine with squared hinge loss, by finite Newton steps."""
    x = np.hstack([x.astype(np.float64), np.ones((len(x), 1))])
    per_row = cost * len(y) / (2.0 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    weights, active = np.zeros(x.shape[1]), np.ones(len(y), dtype=bool)
    for _ in range(steps):
        inside = x[active] * per_row[active][:, None]
        weights = np.linalg.solve(np.eye(x.shape[1]) + inside.T @ x[active], inside.T @ y[active])
        again = y * (x @ weights) < 1
        if (again == active).all():
            break
        active = again
    return weights


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    y = group["y"].to_numpy(dtype=np.float64)
    weights = fit_machine(np.stack(group["x"].to_numpy()), y)
    return pd.DataFrame({"machine": [group["machine"].iloc[0]], "weights": [weights.astype(np.float32)]})


def bounded_sample(rows: DataFrame, label: str, key: Column, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label, those with the smallest key hash.

    Counting labels first turns the bound into a hash threshold with room to spare, so a common label
    sends a bounded number of rows to the exact cut.
    """
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    hashed = rows.withColumn("_h", F.pmod(F.xxhash64(key), F.lit(1 << 30)))
    keep = F.lit(False)
    for value, count in counts.items():
        share = min(1.0, (per_label + 10 * per_label**0.5 + 10) / count)
        keep = keep | ((F.col(label) == F.lit(value)) & (F.col("_h") <= int(share * (1 << 30))))
    ranked = hashed.where(keep).select(
        "*", F.expr(f"row_number() over (partition by {label} order by _h, xxhash64(text), text)").alias("_r")
    )
    return ranked.where(F.col("_r") <= per_label).drop("_h", "_r")


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int = PER_LANGUAGE, size: int = DIMENSIONS) -> dict:
    """Machines of families and of language pairs, fitted side by side on the bounded sample."""
    rows = labelled.where(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(doc_id).cast("string").alias("key")
    )
    sample = bounded_sample(rows, "lang", F.coalesce("key", F.lit("")), per_language)
    sample = stash(sample.select("lang", _features(size)("text").alias("x")), "language-sample").where("x IS NOT NULL")
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    families: dict[str, list[str]] = {}
    for language in languages:
        families.setdefault(family_of(language), []).append(language)
    roles: dict[str, dict[str, int]] = {}
    names = sorted(families)
    if len(names) > 1:
        for family in names[1:] if len(names) == 2 else names:
            roles[f"family {family}"] = {x: 1 if x in families[family] else -1 for x in languages}
    for members in families.values():
        for one, two in combinations(members, 2):
            roles[f"pair {one} {two}"] = {one: 1, two: -1}
    weights: dict[str, np.ndarray] = {}
    if roles:
        cases = [(x, m, float(y)) for m, role in roles.items() for x, y in role.items()]
        table = F.broadcast(sample.sparkSession.createDataFrame(cases, "lang string, machine string, y double"))
        fitted = sample.join(table, "lang").groupBy("machine").applyInPandas(_fit, "machine string, weights array<float>")
        weights = {r["machine"]: np.array(r["weights"], dtype=np.float32) for r in fitted.collect()}
    return {"families": families, "weights": weights, "size": size}


def decide(vector: np.ndarray, model: dict) -> tuple[str, float]:
    """Language and score of one text: family first, then votes between its languages."""
    families, weights = model["families"], model["weights"]
    names = sorted(families)

    def margin(machine: str) -> float:
        w = weights[machine]
        return float(vector @ w[:-1] + w[-1])

    sure = 1.0
    family = names[0]
    if len(names) == 2:
        m = margin(f"family {names[1]}")
        family, sure = (names[1], _chance(m)) if m > 0 else (names[0], _chance(-m))
    elif len(names) > 2:
        margins = {f: margin(f"family {f}") for f in names}
        family = max(names, key=margins.__getitem__)
        sure = _chance(margins[family])
    members = families[family]
    votes, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
    for one, two in combinations(members, 2):
        m = margin(f"pair {one} {two}")
        votes[one if m > 0 else two] += 1
        sums[one] += m
        sums[two] -= m
    winner = max(members, key=lambda x: (votes[x], sums[x]))
    if len(members) > 1:
        sure *= _chance(sums[winner] / (len(members) - 1))
    return winner, sure


def _chance(margin: float) -> float:
    return 1.0 / (1.0 + float(np.exp(-3.0 * max(-20.0, min(20.0, margin)))))


def predict(text: Column, model: dict) -> Column:
    """Struct column of ``lang`` and ``score`` (0 to 1)."""

    def answer(batches):
        letters = _letter_table()
        for texts in batches:
            rows = []
            for t in texts:
                vector = ngram_vector(t.as_py(), letters, model["size"]) if model["families"] else None
                rows.append((UNDETERMINED, 0.0) if vector is None else decide(vector, model))
            yield pa.StructArray.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())],
                names=["lang", "score"],
            )

    return text_function(answer, "struct<lang:string,score:double>")(text)
