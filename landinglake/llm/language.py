"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams (n = 1 to 3, blended) present in both,
over the root of the product of how many each has. N-grams are over the code points of lower-cased
letters of any script, three of which fit in 64 bits; any run of other characters is one space. A Nyström map on a few landmark texts per language makes
finite features, and one-versus-rest kernel ridge regression on these separates the languages.
As the kernel is a sum over n-grams, landmarks and regression fold into weights per n-gram of the
landmarks; a text's score is the sum of the weights of its n-grams.

The fit uses at most ``sample`` labelled rows per language, with ``landmarks`` of them as
landmarks, taken by a hash of text and language; whole texts count, as sets of n-grams. All rows are
scored.

Edge cases: a null text or one without letters is ``und`` with score 0; rows with a null language
or excluded by ``learn`` teach nothing; without any labelled text everything is ``und``; repeated
rows get equal results; ties go to the first language by name; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landinglake.llm.dealing import look_up, run_starts, steps
from landinglake.llm.tables import sample_texts, stored

UNKNOWN = "und"
SAMPLE = 400
LANDMARKS = 48
RIDGE = 1e-3
# Length of the longest n-grams, and bits per code point in them.
GRAMS = 3
BITS = 21
_POINTS = 0x110000
# Texts by n-grams whose presence is laid out at a time.
CELLS = 1 << 22


def letters_of(text: str) -> np.ndarray:
    """Lower-case code points of a text; what is not a letter is 0."""
    points = _points(text)
    return np.where(_letter_table()[points], points, 0)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


_TABLES: dict[str, np.ndarray] = {}


def _letter_table() -> np.ndarray:
    if "letters" not in _TABLES:
        _TABLES["letters"] = np.array([chr(c).isalpha() for c in range(_POINTS)])
    return _TABLES["letters"]


def alphabet_table(letters=()) -> np.ndarray:
    """Symbol of every code point: 1 for what is no letter, else one more than the code point.
    ``letters`` are code points that count as letters whatever Unicode says."""
    table = np.where(_letter_table(), np.arange(1, _POINTS + 1), 1).astype(np.int32)
    chosen = np.asarray(letters, np.int64)
    table[chosen] = chosen + 1
    return table


def present_grams(text: str, table: np.ndarray, flags: np.ndarray | None = None) -> np.ndarray:
    """The n-grams that occur in a text, sorted; no symbol is 0, so those of different length
    differ. ``flags`` is not needed."""
    symbols = table[_points(text)].astype(np.int64)
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 1) | (symbols[:-1] != 1)  # runs of spaces are one
    symbols = symbols[keep]
    grams = [symbols]
    for n in range(1, GRAMS):
        grams.append((grams[-1][:-1] << BITS) | symbols[n:])
    # Sorted one by one, as shorter ones are less than longer ones.
    ordered = np.concatenate([np.sort(g) for g in grams])
    return ordered[run_starts(ordered)]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # symbol of each code point
    grams: np.ndarray  # the n-grams of the landmarks, sorted
    weights: np.ndarray  # n-gram by language
    bias: np.ndarray

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best language's number (-1 without letters) and score of each text."""
        best, scores = np.full(len(texts), -1), np.zeros(len(texts))
        size = max(1, min(len(texts), CELLS // max(1, len(self.grams))))
        present = np.zeros((size, len(self.grams)), np.float32)
        for begin in range(0, len(texts), size):
            used, lengths, some = [], np.ones(size), np.zeros(size, bool)
            for row, text in enumerate(texts[begin:begin + size]):
                found = present_grams(text, self.table)
                some[row] = ((found > 1) & (found < 1 << BITS)).any()
                known, at = look_up(self.grams, found)
                used.append(at[known])
                present[row, used[-1]] = 1
                lengths[row] = max(1, len(found))
            # One product for the block: presence by n-gram times weights by n-gram.
            values = present @ self.weights / np.sqrt(lengths)[:, None] + self.bias
            for row, at in enumerate(used):
                present[row, at] = 0
            rows = np.flatnonzero(some)
            best[begin + rows] = values[rows].argmax(axis=1)
            scores[begin + rows] = np.clip(values[rows].max(axis=1), 0, 1)
        return best, scores


def learning_rows(docs: DataFrame, learn: Column, sample: int) -> DataFrame:
    """(lang, text, place): at most ``sample`` different texts per language, in order of a hash."""
    known = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = known.select(F.col("lang").cast("string").alias("lang"), "text")
    return sample_texts(rows, "lang", "text", sample)


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE, landmarks: int = LANDMARKS,
        ridge: float = RIDGE) -> Model | None:
    """Fit on a bounded sample of the rows of ``docs`` (text, lang) for which ``learn`` holds."""
    rows = stored(learning_rows(docs, learn, sample), "learning")
    if rows.isEmpty():
        return None

    table = alphabet_table()
    known = docs.sparkSession.sparkContext.broadcast(table)

    def grams(batches):
        for batch in batches:
            found = [present_grams(text, known.value).tobytes()
                     for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("place"), pa.array(found, pa.binary())],
                names=["lang", "place", "grams"])

    # At most ``sample`` texts per language reach the driver, each as its distinct n-grams.
    taught = rows.mapInArrow(grams, "lang string, place int, grams binary").toArrow().to_pylist()
    taught.sort(key=lambda r: (r["lang"], r["place"]))
    return solve([(r["lang"], r["place"] <= landmarks, np.frombuffer(r["grams"], np.int64))
                  for r in taught], table, ridge)


def solve(taught, table: np.ndarray, ridge: float) -> Model:
    """The model of (language, is landmark, n-grams) rows."""
    languages = sorted({lang for lang, _, _ in taught})
    marks = [grams for _, is_mark, grams in taught if is_mark]
    used = np.unique(np.concatenate(marks)) if marks else np.zeros(0, np.int64)
    places = [np.searchsorted(used, grams) for grams in marks]
    joined = np.concatenate(places) if places else np.zeros(0, np.int64)
    ends = np.cumsum([0, *map(len, places)])
    mark_sizes = np.sqrt([max(1, len(g)) for g in marks])

    def kernel_rows(sets):
        # By set and landmark; the n-grams are never laid out as a dense matrix.
        rows, present = np.zeros((len(sets), len(marks))), np.zeros(len(used), bool)
        for row, grams in enumerate(sets):
            shared, at = look_up(used, grams)
            present[at[shared]] = True
            rows[row] = np.diff(np.r_[0, np.cumsum(present[joined])][ends])
            rows[row] /= mark_sizes * np.sqrt(max(1, len(grams)))
            present[at[shared]] = False
        return rows

    kernel = kernel_rows(marks)
    values, vectors = np.linalg.eigh(kernel)
    strong = values > 1e-8 * values[-1]
    nystroem = vectors[:, strong] / np.sqrt(values[strong])
    features = kernel_rows([grams for _, _, grams in taught]) @ nystroem
    centre = features.mean(0)
    target = np.array([[float(lang == each) for each in languages] for lang, _, _ in taught])
    # Every language weighs the same, however many rows it has.
    weight = 1 / target.sum(0)[target.argmax(1)]
    spread = (features - centre) * weight[:, None]
    left = (features - centre).T @ spread + ridge * np.eye(features.shape[1])
    middle = (target * weight[:, None]).sum(0) / weight.sum()
    solved = np.linalg.solve(left, spread.T @ (target - middle))
    folded = np.zeros((len(used), len(languages)))
    for place, own in zip(places, (nystroem @ solved) / mark_sizes[:, None]):
        folded[place] += own
    return Model(languages, table, used, folded.astype(np.float32),
                 (middle - centre @ solved).astype(np.float32))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text)."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        model = known.value
        for batch in steps(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            if model is None:
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            else:
                best, scores = model.score(texts)
                names = [model.languages[b] if b >= 0 else UNKNOWN for b in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        predict, "doc_id bigint, lang_pred string, score double")
