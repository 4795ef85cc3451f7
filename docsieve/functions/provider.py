"""Text-embedding models as providers: a name, a dimension and a way to load the model in a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Model = Callable[[list[str]], Sequence[Sequence[float]]]

_AT_ONCE = 256  # texts that a model gets in one call


@dataclass(frozen=True)
class Provider:
    """A model by name. ``load`` runs once in every task and returns a function from texts to vectors."""

    model_name: str
    dimension: int
    load: Callable[[], Model]

    def vectors(self, model: Model, texts: list[str]) -> list[np.ndarray]:
        """The vectors of some texts; a wrong number or length of them is an error."""
        found = [np.asarray(v, dtype=np.float32) for v in model(texts)]
        if len(found) != len(texts):
            raise ValueError(f"{self.model_name} gave {len(found)} vectors for {len(texts)} texts")
        for v in found:
            if v.shape != (self.dimension,):
                raise ValueError(f"{self.model_name} gave a vector of {v.size} values, its dimension is {self.dimension}")
        return found


def embedded(text: Column | str, provider: Provider) -> Column:
    """Vectors of a text column, in Arrow batches of which a model sees some texts at a time; null texts count as empty."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = provider.load()
        for texts in batches:
            for at in range(0, len(texts), _AT_ONCE):
                some = ["" if x is None else x for x in texts.slice(at, _AT_ONCE).to_pylist()]
                found = provider.vectors(model, some)
                ends = np.arange(len(found) + 1, dtype=np.int32) * provider.dimension
                yield pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found), from_pandas=True))

    return run(text)


def with_vectors(
    df: DataFrame, text: str, provider: Provider, vector: str = "embedding", model: str = "vector_model", dimensions: str = "dimensions"
) -> DataFrame:
    """``df`` with the vector, the model's name and the dimension; columns of these names are replaced.

    The vectors leave through a generator of one row. As a plain column, Spark would run the model once more
    for every filter on them, as it adds where they are exploded.
    """
    made = "_vector"
    while made in (c.lower() for c in df.columns):
        made += "_"
    rows = df.select("*", F.inline(F.array(F.struct(embedded(text, provider).alias(made)))))
    return rows.withColumns({
        vector: F.col(made), model: F.lit(provider.model_name), dimensions: F.lit(provider.dimension)
    }).drop(made)


def query_vector(text: str, provider: Provider) -> list[float]:
    """The vector of one query text, made on the driver and checked like those of the table."""
    return [float(x) for x in provider.vectors(provider.load(), [text])[0]]
