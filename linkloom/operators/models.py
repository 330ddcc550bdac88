"""Slot for a user's own model.

The model sees batches of texts inside Spark tasks. Only the text and language
columns cross to Python; the other columns of the table stay where they are.
A row that fails yields an empty result and an error text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from linkloom.functions.entities import ENTITY_TYPE

Model = Callable[[Sequence[str], Sequence[str]], Sequence[Any]]
"""Called with texts and their languages; returns one result per text."""

RESULT_TYPES = {
    "entities": ENTITY_TYPE,
    "labels": "array<struct<label:string,score:double>>",
}


def _run(model: Model, texts: list[str], languages: list[str]) -> list[tuple[Any, str | None]]:
    """One batch; if it fails, its halves, so that only the bad rows are lost.

    A batch with k bad rows costs about ``2 k log2(size / k)`` further calls.
    """
    try:
        found = list(model(texts, languages))
        if len(found) != len(texts):
            raise ValueError("a model must return one result per text")
        return [(r, None) for r in found]
    except Exception as failure:
        if len(texts) == 1:
            return [([], str(failure) or type(failure).__name__)]
        half = len(texts) // 2
        return _run(model, texts[:half], languages[:half]) + _run(model, texts[half:], languages[half:])


def model_column(
    text: Column, language: Column, load_model: Callable[[], Model], kind: str, batch_size: int = 256
) -> Column:
    """``struct<result, error>`` for each text.

    ``load_model`` runs once per task. Missing texts do not reach the model.
    """
    schema = T.DataType.fromDDL(f"struct<result:{RESULT_TYPES[kind]},error:string>")
    arrow, names = to_arrow_type(schema), schema["result"].dataType.elementType.names

    def as_arrow(found: list[tuple[Any, str | None]]) -> pa.Array:
        def entry(e: Any) -> Any:
            return e if e is None or isinstance(e, dict) else dict(zip(names, e))

        rows = [{"result": None if result is None else [entry(e) for e in result], "error": error} for result, error in found]
        return pa.array(rows, arrow)

    @F.arrow_udf(schema)
    def apply(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = load_model()
        for texts, languages in batches:
            usable = np.flatnonzero(pc.greater(pc.binary_length(texts), 0).fill_null(False).to_numpy(zero_copy_only=False))
            # Only the texts and results of one call are Python objects at a time.
            done = [as_arrow([([], None)])]
            for at in range(0, len(usable), batch_size):
                rows = pa.array(usable[at : at + batch_size])
                done.append(as_arrow(_run(model, texts.take(rows).to_pylist(), languages.take(rows).to_pylist())))
            place = np.zeros(len(texts), np.int64)
            place[usable] = 1 + np.arange(len(usable))
            yield pa.concat_arrays(done).take(pa.array(place))

    return apply(text, language)


def apply_model(
    df: DataFrame,
    text: str,
    language: str | Column,
    load_model: Callable[[], Model],
    kind: str,
    output: str,
    error: str = "error",
    batch_size: int = 256,
) -> DataFrame:
    """Add the model's result and an error column (null where all went well)."""
    if text not in df.columns:
        raise ValueError(f"column {text} not found")
    language = F.col(language) if isinstance(language, str) else language
    called = df.withColumn("_model", model_column(F.col(text), language, load_model, kind, batch_size))
    return called.withColumns({output: F.col("_model.result"), error: F.col("_model.error")}).drop("_model")


def top_model_labels(result: Column, top_k: int) -> Column:
    """Names of the best ``top_k`` labels a model returned; equal scores keep the model's order."""
    placed = F.transform(
        result,
        lambda e, i: F.struct((-e["score"]).alias("loss"), i.alias("pos"), e["label"].alias("label")),
    )
    return F.transform(F.slice(F.array_sort(placed), 1, top_k), lambda e: e["label"])
