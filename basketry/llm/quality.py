"""Quality rules as weak supervision.

Each rule looks at one property of a text and votes good, bad, or abstains.  No rule has a
veto.  How far each vote can be trusted is learned without labels: a two-class mixture in which
every rule votes independently given the class (Dawid and Skene) is fitted by expectation-
maximisation, and a text is judged by the posterior probability of the good class.

The fit needs only how often each pattern of votes occurs.  Spark counts the patterns over all
documents; there are at most 3 ** (number of rules) of them however large the corpus is, so the
iterations run on that table.

Defined results: a null or empty text has no words, fails the base rule and is not kept;
repeated rows are judged alike; an empty table gives an empty result; columns other than the id
and the text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from basketry.llm.common import SPACE, bodies, python_rows, restored
from basketry.session import materialise

GOOD, ABSTAIN, BAD = 1, 0, -1
VOTES = (BAD, ABSTAIN, GOOD)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_distinct_words", "n_bangs", "n_upper", "n_lower", "n_letters")

_SYMBOLS = list(b"#*$%&|<>")
_SPACES = list(SPACE)
_WIDE_VOCABULARY = 2_000_000  # three word numbers below this fit one 63-bit number


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Distinct words, and words inside a 3-word window that occurs twice or more."""
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    m = len(numbers)
    if m == len(words) or len(words) < 4:
        return m, 0
    a = np.array(ids, dtype=np.int64)
    pairs = a[:-2] * m + a[1:-1]
    if m >= _WIDE_VOCABULARY:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs * m + a[2:]
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return m, 0
    starts = np.isin(windows, again)
    covered = np.zeros(len(a), dtype=bool)
    for shift in range(3):
        covered[shift:shift + len(starts)] |= starts
    return m, int(covered.sum())


def features_of(body: bytes) -> tuple[int, ...]:
    """The numbers of one text, in the order of ``FEATURES``."""
    words = body.split()
    lines = [line for line in body.split(b"\n") if line.strip(SPACE)]
    distinct, repeated = repeated_words(words)
    counts = np.bincount(np.frombuffer(body, dtype=np.uint8), minlength=256)
    code_points = len(body) - int(counts[0x80:0xC0].sum())
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    return (len(words), code_points - int(counts[_SPACES].sum()), int(counts[_SYMBOLS].sum()),
            len(lines) - len(set(lines)), repeated, len(lines), distinct, int(counts[33]),
            upper, lower, upper + lower + int(counts[0xC0:].sum()))


def _feature_step(batches):
    for batch in batches:
        rows = [features_of(b.as_py()) for b in batch.column("body")]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(FEATURES)
        kept = [n for n in batch.schema.names if n != "body" or "_row" in batch.schema.names]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), *(pa.array(c, pa.int64()) for c in columns)],
            names=[*kept, *FEATURES])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             whole: bool = False) -> DataFrame:
    """One row of numbers per document; ``whole`` takes the document along."""
    taken = bodies(docs, id_col, text_col, whole)
    schema = T.StructType([f for f in taken.schema.fields if f.name != "body" or whole]
                          + [T.StructField(n, T.LongType()) for n in FEATURES])
    return python_rows(taken, _feature_step, schema)


def _share(top: str, bottom: str) -> Column:
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def _rule(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), ABSTAIN).when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def rules() -> dict[str, Column]:
    """Vote of each rule as an expression on the features."""
    symbols = _share("n_symbols", "n_words")
    bangs = _share("n_bangs", "n_words")
    capitals = F.col("n_upper") / F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1))
    lines = F.when(F.col("n_lines") >= 2, _share("n_dup_lines", "n_lines"))
    windows = _share("n_repeat_words", "n_words")
    length = _share("word_chars", "n_words")
    # Long texts repeat words by nature; there the rule has nothing to say.
    variety = F.when(F.col("n_words") <= 1000, _share("n_distinct_words", "n_words"))
    letters = _share("n_letters", "word_chars")
    return {
        "symbols": _rule(symbols, symbols <= 0.05, symbols > 0.2),
        "bangs": _rule(bangs, bangs <= 0.05, bangs > 0.3),
        "capitals": _rule(capitals, capitals <= 0.15, capitals > 0.4),
        "repeated_lines": _rule(lines, lines <= 0.1, lines > 0.3),
        "repeated_windows": _rule(windows, windows <= 0.1, windows > 0.3),
        "word_length": _rule(length, length.between(3, 9), (length < 2) | (length > 15)),
        "variety": _rule(variety, variety >= 0.3, variety < 0.15),
        "letters": _rule(letters, letters >= 0.93, letters < 0.7),
    }


@dataclass(frozen=True)
class VoteModel:
    """Share of good texts and, per rule, the chance of each vote in either class."""

    names: tuple[str, ...]
    good_share: float
    chances: np.ndarray  # [rule, class (bad, good), vote (bad, abstain, good)]

    def log_odds(self) -> Column:
        """Log odds of the good class from the vote columns."""
        weights = np.log(self.chances[:, 1] / self.chances[:, 0])
        total = F.lit(float(np.log(self.good_share / (1 - self.good_share))))
        for name, weight in zip(self.names, weights, strict=True):
            vote = F.col(f"vote_{name}")
            total = total + (F.when(vote == BAD, float(weight[0]))
                             .when(vote == GOOD, float(weight[2])).otherwise(float(weight[1])))
        return total

    def accuracies(self) -> dict[str, float]:
        """Chance that a rule is right when it does not abstain."""
        share = np.array([1 - self.good_share, self.good_share])
        right = share[0] * self.chances[:, 0, 0] + share[1] * self.chances[:, 1, 2]
        wrong = share[0] * self.chances[:, 0, 2] + share[1] * self.chances[:, 1, 0]
        return dict(zip(self.names, (right / (right + wrong)).tolist(), strict=True))


# Prior pseudo-counts as shares of the corpus: bad votes are rare in good texts, and a bad text
# breaks some rules only.  They name the classes and keep a chance off zero at every corpus size.
_PRIOR_SHARE = 0.02
_PRIOR_GOOD_SHARE = 0.85
_PRIOR = np.array([[0.35, 0.15, 0.5], [0.01, 0.04, 0.95]])


def fit_votes(names: tuple[str, ...], patterns: np.ndarray, counts: np.ndarray,
              iterations: int = 200, tolerance: float = 1e-9) -> VoteModel:
    """Expectation-maximisation over vote patterns ``[pattern, rule]`` and their counts."""
    n_rules = len(names)
    good, chances = _PRIOR_GOOD_SHARE, np.repeat(_PRIOR[None], n_rules, axis=0)
    total = float(counts.sum())
    if not total:
        return VoteModel(names, good, chances)
    one_hot = np.stack([patterns == v for v in VOTES], axis=2).astype(float)
    prior = _PRIOR_SHARE * total
    last = -np.inf
    for _ in range(iterations):
        score = np.einsum("prv,rcv->pc", one_hot, np.log(chances)) + np.log([1 - good, good])
        top = score.max(axis=1, keepdims=True)
        evidence = top[:, 0] + np.log(np.exp(score - top).sum(axis=1))
        weight = np.exp(score - evidence[:, None]) * counts[:, None]
        good = float((weight[:, 1].sum() + prior * _PRIOR_GOOD_SHARE) / (total + prior))
        seen = np.einsum("prv,pc->rcv", one_hot, weight) + prior * _PRIOR
        chances = seen / seen.sum(axis=2, keepdims=True)
        mean = float((evidence * counts).sum() / total)
        if abs(mean - last) < tolerance:
            break
        last = mean
    return VoteModel(names, good, chances)


def count_patterns(voted: DataFrame, names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """How often each pattern of votes occurs; at most 3 ** rules rows leave the executors."""
    columns = [f"vote_{n}" for n in names]
    rows = voted.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sorted(tuple(r) for r in rows)
    table = np.array(rows, dtype=np.int64).reshape(len(rows), len(names) + 1)
    return table[:, :-1], table[:, -1].astype(float)


def _voted(docs: DataFrame, id_col: str, text_col: str, whole: bool = False) -> DataFrame:
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return (features(docs, id_col, text_col, whole).withColumn("base_failed", failed)
            .withColumns({f"vote_{n}": v.cast("int") for n, v in rules().items()}))


def _verdicts(voted: DataFrame, model: VoteModel, threshold: float) -> DataFrame:
    return (voted.withColumn("p_good", 1 / (1 + F.exp(-model.log_odds())))
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))


def _fitted(voted: DataFrame) -> VoteModel:
    names = tuple(rules())
    return fit_votes(names, *count_patterns(voted.where(~F.col("base_failed")), names))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """Features, votes, posterior ``p_good`` and verdict ``kept`` per document.

    Texts that fail the base rule (fewer than 50 words, or more than half of the words inside
    repeated windows) are out and do not take part in the fit.
    """
    voted = materialise(_voted(docs, id_col, text_col), "quality-votes")
    return _verdicts(voted, _fitted(voted), threshold)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = 0.5) -> DataFrame:
    """The rows that ``judge`` keeps, with all their columns as they came.

    Votes are counted first and cast again as the rows are written, so no text is kept aside.
    """
    model = _fitted(_voted(docs, id_col, text_col))
    good = _verdicts(_voted(docs, id_col, text_col, whole=True), model, threshold).where("kept")
    return restored(good, docs, text_col)
