"""Language identification with string kernels.

The kernel of two texts counts the byte n-grams of one to GRAMS bytes that occur in both (a blended spectrum of
presences), over the square root of how many each has. Landmark texts span a Nyström approximation of it, on which
one-versus-rest ridge regressors are fitted; texts are scored in batches of pieces by two matrix products. The n-grams counted
are those of the landmarks: no other can agree with one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyquarry.llm.common import byte_buffer, map_arrow

GRAMS = 3
#: Rows that train at most (those of the least hashes of their ids), and landmarks.
TRAIN_ROWS, LANDMARKS = 2000, 192
#: A text of more than this many characters trains by STRETCHES pieces of it, spread evenly.
LESSON, STRETCHES = 20_000, 10
#: Bytes of a piece: a text's score is the mean of its pieces', by their bytes, so that a foreign passage counts by its length.
PIECE, BATCH = 1500, 256
RIDGE, EIGEN_FLOOR = 1e-2, 1e-6

_FOLD = np.arange(256, dtype=np.int64)
_FOLD[65:91] += 32


def grams(text: np.ndarray) -> np.ndarray:
    """A number for every n-gram, of 1 to GRAMS bytes, A-Z lower-cased; repeats included."""
    t = _FOLD[text]
    parts, code, base = [t], t, 256
    for n in range(2, GRAMS + 1):
        if len(t) < n:
            break
        code = code[:-1] * 256 + t[n - 1 :]
        parts.append(code + base)
        base += 256**n
    return np.concatenate(parts)


SPACE = sum(256**n for n in range(1, GRAMS + 1))


class Model:
    """Landmark n-grams, landmark presences and the weights of each language."""

    def __init__(self, texts: list[bytes], langs: list[str], seed: int = 5):
        self.langs = sorted(set(langs))
        rng = np.random.default_rng(seed)
        arrays = [np.frombuffer(t, np.uint8) for t in texts]
        by_lang = {g: rng.permutation([i for i, x in enumerate(langs) if x == g]).tolist() for g in self.langs}
        marks: list[int] = []
        while len(marks) < min(LANDMARKS, len(texts)):  # from each language in turn
            marks += [by_lang[g].pop() for g in self.langs if by_lang[g]]
        sets = [np.unique(grams(arrays[i])) for i in marks]
        self.vocabulary = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.int64)
        self.landmarks = np.zeros((len(self.vocabulary) + 1, len(sets)), np.float32)
        for j, s in enumerate(sets):
            self.landmarks[1 + np.searchsorted(self.vocabulary, s), j] = 1
        self.landmarks /= np.sqrt(np.maximum(1, self.landmarks.sum(0)))
        self.weights = np.zeros((len(sets) + 1, len(self.langs)))
        if len(self.langs) > 1:
            table = self.table()
            k = np.concatenate([self.kernel(arrays[i : i + 256], table) for i in range(0, len(arrays), 256)]).astype(float)
            values, vectors = np.linalg.eigh(self.landmarks.T @ self.landmarks)
            use = values > EIGEN_FLOOR * values[-1]
            root = vectors[:, use] / np.sqrt(values[use])  # the Nyström map
            phi = np.column_stack([k @ root, np.ones(len(k))])
            y = np.array([[x == g for g in self.langs] for x in langs], float)
            w = 1 / np.array([langs.count(x) for x in langs], float)  # every language weighs the same
            solved = np.linalg.solve(phi.T @ (phi * w[:, None]) + RIDGE / len(phi) * np.eye(phi.shape[1]), phi.T @ (y * w[:, None]))
            self.weights = np.vstack([root @ solved[:-1], solved[-1:]])

    @classmethod
    def of(cls, state: dict) -> Model:
        """The model of vars(model): plain arrays travel to workers that do not have this package."""
        out = cls.__new__(cls)
        vars(out).update(state)
        return out

    def table(self) -> np.ndarray:
        """Column of each n-gram; 0 for those that no landmark has."""
        at = np.zeros(SPACE, np.int32)
        at[self.vocabulary] = 1 + np.arange(len(self.vocabulary))
        return at

    def kernel(self, texts: list[np.ndarray], table: np.ndarray) -> np.ndarray:
        """The kernel of texts with every landmark, as one matrix product."""
        has = np.zeros((len(texts), len(self.vocabulary) + 1), np.float32)
        for i, t in enumerate(texts):
            if len(t):
                has[i, table[grams(t)]] = 1
        has[:, 0] = 0
        return (has @ self.landmarks) / np.sqrt(np.maximum(1, has.sum(1)))[:, None]

    def scores(self, texts: list[np.ndarray], table: np.ndarray) -> np.ndarray:
        """One row per text, over all its pieces."""
        pieces = [(i, t[k : k + PIECE]) for i, t in enumerate(texts) for k in range(0, max(1, len(t)), PIECE)]
        out, sizes = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for k in range(0, len(pieces), BATCH):
            of, part = zip(*pieces[k : k + BATCH], strict=True)
            size = np.array([max(1, len(p)) for p in part], float)
            got = self.kernel(list(part), table) @ self.weights[:-1] + self.weights[-1]
            np.add.at(out, list(of), got * size[:, None])
            np.add.at(sizes, list(of), size)
        return out / sizes[:, None]


def trained(docs: DataFrame, may_learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_ROWS) -> Model:
    """A model of at most `most` rows for which may_learn holds and language and text are known."""
    text = F.col(text_col)
    size = F.length(text)
    parts = F.concat(*[F.substring(text, F.floor((size - LESSON // STRETCHES) * i / (STRETCHES - 1)).cast("int") + 1, F.lit(LESSON // STRETCHES)) for i in range(STRETCHES)])
    rows = docs.where(may_learn & F.col(lang_col).isNotNull() & text.rlike(r"\p{L}") & F.col(id_col).isNotNull())
    rows = rows.select(id_col, F.when(size > LESSON, parts).otherwise(text).alias("_text"), F.col(lang_col).alias("_lang"))
    # ids first: what every task sends to be ordered is small, and only the chosen texts come to the driver, one for each id
    chosen = rows.select(id_col).distinct().orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(most)
    one = rows.join(F.broadcast(chosen), id_col).groupBy(id_col).agg(F.min(F.struct("_text", "_lang")).alias("row"))
    got = sorted(tuple(r) for r in one.select("row._text", "row._lang").collect())
    return Model([text.encode() for text, _ in got], [lang for _, lang in got])


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and lang_score (0 to 1), over whole texts. Texts that are null or have no letter are `und`, of score 0.

    Columns of these two names are replaced, all others are kept. With one language learned, every text with a letter has it, of score 1; with none, all are `und`.
    """
    fields = [f for f in docs.schema.fields if f.name not in ("lang_pred", "lang_score")]
    at = [f.name for f in fields].index(text_col)
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])
    types = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # bounded by LANDMARKS texts of LESSON characters

    def kernel(it):
        model = Model.of(shared.value)
        table = model.table()
        for b in it:
            data, offsets = byte_buffer(b.column(at))
            letters = b.column(len(fields)).to_pylist()
            names, values = [], []
            for i in range(0, len(b), 256):
                n = min(256, len(b) - i)
                texts = [data[offsets[i + k] : offsets[i + k + 1]] for k in range(n)]
                got = model.scores(texts, table) if len(model.langs) > 1 else np.ones((n, len(model.langs)))
                for k, s in enumerate(got):
                    known = letters[i + k] and len(s)
                    names.append(model.langs[int(s.argmax())] if known else "und")
                    values.append(float(np.clip(s.max(), 0, 1)) if known else 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(fields)], pa.array(names, pa.string()), pa.array(values, pa.float64())], schema=types)

    has = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    return map_arrow(docs.select(*[F.col(f"`{f.name}`") for f in fields], has.alias(max(docs.columns, key=len) + "_")), kernel, schema)
