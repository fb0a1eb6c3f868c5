"""User-defined functions: Python classes with eval, and models, as Arrow-batched Spark functions."""

from __future__ import annotations

import importlib
import inspect
import typing
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.package import ship

PYTHON_TYPES = {str: T.StringType(), int: T.LongType(), float: T.DoubleType(), bool: T.BooleanType(), bytes: T.BinaryType()}


def load(path: str) -> type:
    module, _, name = path.rpartition(".")
    return getattr(importlib.import_module(module), name)


def result_type(kind: type, evaluate: Callable) -> T.DataType:
    """What getReturnType says, else what eval is annotated with."""
    if hasattr(kind, "getReturnType"):
        hinted = kind.getReturnType(kind())
        if hinted is not None:
            return hinted if isinstance(hinted, T.DataType) else T._parse_datatype_string(hinted)
    hint = typing.get_type_hints(evaluate).get("return")
    hint = next((a for a in typing.get_args(hint) if a is not type(None)), hint) if typing.get_origin(hint) is not list and typing.get_args(hint) else hint
    if typing.get_origin(hint) is list:
        return T.ArrayType(PYTHON_TYPES[typing.get_args(hint)[0]])
    if hint not in PYTHON_TYPES:
        raise ValueError(f"{kind.__name__}.eval must be annotated with its result's type, or the class have getReturnType")
    return PYTHON_TYPES[hint]


def chosen(kind: type, types: list[T.DataType]) -> Callable:
    """The eval for these argument types: eval, or of eval and eval_<name> the first whose annotations fit."""
    overloads = [getattr(kind, n) for n in sorted(vars(kind)) if n == "eval" or n.startswith("eval_")] or [kind.eval]

    def fits(evaluate: Callable) -> bool:
        hints, params = typing.get_type_hints(evaluate), [p for p in inspect.signature(evaluate).parameters.values() if p.name != "self"]
        if any(p.kind is p.VAR_POSITIONAL for p in params):
            return True
        if len(params) != len(types):
            return False
        for p, t in zip(params, types, strict=True):
            hint = hints.get(p.name)
            hint = next((a for a in typing.get_args(hint) if a is not type(None)), hint)
            want = PYTHON_TYPES.get(hint)
            if want is not None and not (type(want) is type(t) or isinstance(t, T.NullType) or isinstance(want, T.LongType) and isinstance(t, T.IntegralType) or isinstance(want, T.DoubleType) and isinstance(t, T.NumericType)):
                return False
        return True

    found = next((e for e in overloads if fits(e)), None)
    if found is None:
        raise ValueError(f"{kind.__name__} has no eval for ({', '.join(t.simpleString() for t in types)})")
    return found


def scalar(kind: type, options: Mapping[str, str] | None = None) -> Callable:
    """A function from columns to a column. A task makes one object, opens it with the options, and closes it at the
    end."""
    options = dict(options or {})

    def call(*cols: Column, types: list[T.DataType]) -> Column:
        ship()
        evaluate = chosen(kind, types)
        name, returns = evaluate.__name__, result_type(kind, evaluate)

        def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            one = kind()
            if hasattr(one, "open"):
                one.open(options)
            try:
                for batch in batches:
                    columns = [[None if v is None or v is pd.NaT or isinstance(v, float) and v != v else v for v in s] for s in batch]
                    yield pd.Series([getattr(one, name)(*row) for row in zip(*columns, strict=True)], dtype=object)
            finally:
                if hasattr(one, "close"):
                    one.close()

        def single(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            yield from run((b,) for b in batches)

        # without arguments a constant column gives the number of rows
        if not cols:
            def none(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
                one = kind()
                if hasattr(one, "open"):
                    one.open(options)
                for b in batches:
                    yield pd.Series([getattr(one, name)() for _ in b], dtype=object)

            none.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
            return F.pandas_udf(none, returns)(F.lit(0))
        work = single if len(cols) == 1 else run
        work.__annotations__ = {"batches": Iterator[pd.Series] if len(cols) == 1 else Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
        return F.pandas_udf(work, returns)(*cols)

    return call


class LocalChat:
    """A stand-in for a chat model: says back what it was told, with its prompt. It needs no network."""

    def open(self, options: Mapping[str, str]) -> None:
        self.prompt = options.get("openai.chat.prompt") or options.get("prompt", "")

    def eval(self, text: str) -> str:
        return f"{self.prompt}{text or ''}"


class LocalEmbedding:
    """A stand-in for an embedding model: a unit vector from hashed character trigrams; an empty text has none."""

    def open(self, options: Mapping[str, str]) -> None:
        self.width = int(options.get("dimensions", 16))

    def getReturnType(self) -> T.DataType:  # noqa: N802
        return T.ArrayType(T.FloatType())

    def eval(self, text: str) -> list[float]:
        import zlib

        out = np.zeros(self.width)
        for i in range(len(text or "") - 2):
            out[zlib.crc32(text[i : i + 3].encode()) % self.width] += 1
        size = np.linalg.norm(out)
        return (out / size).tolist() if size else []


MODELS = {"LocalChat": LocalChat, "LocalEmbedding": LocalEmbedding}
#: Names of models behind a network service, which an own class must stand for: a definition that asks for one fails.
REMOTE = ("OpenAIChatModel", "OpenAIEmbeddingModel")


def model_class(name: str) -> object:
    if name in REMOTE:
        raise ValueError(f"{name} needs a network service: give the path of a class that calls one, or {' or '.join(MODELS)} as a stand-in")
    return MODELS[name] if name in MODELS else load(name)


def registered(udfs: tuple, models: tuple = ()) -> dict[str, Callable]:
    """Functions by name from definitions of UDFs and models; a model's class is a name here or a path."""
    out = {u.name: scalar(load(u.classpath), u.options) for u in udfs}
    return out | {m.name: scalar(model_class(m.class_name), m.options) for m in models}
