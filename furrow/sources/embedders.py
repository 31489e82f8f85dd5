"""Embedding back ends behind one interface, chosen by name, never swapped silently."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import lexical_embedder
from ..settings import Settings
from .http import growing, insist, post_json


class Embedder(Protocol):
    name: str
    dim: int
    semantic: bool

    def embed_passages(self, df: DataFrame, text: str, as_: str) -> DataFrame: ...
    def embed_query(self, text: str) -> list[float]: ...
    def token_column(self, text: str) -> Column | None: ...
    def describe(self) -> str: ...


def _unit(vector) -> list[float]:
    size = math.sqrt(sum(v * v for v in vector))
    return [v / size for v in vector] if size else list(vector)


class LexicalEmbedder:
    """Hashed character 3-grams: matches spellings, not meanings."""

    name, semantic = "lexical-char3gram", False

    def __init__(self, settings: Settings):
        self.dim = settings.embedding_dim
        self._embed = lexical_embedder(self.dim)

    def embed_passages(self, df, text, as_):
        return df.withColumn(as_, self._embed(F.col(text)))

    def embed_query(self, text):
        return [float(x) for x in self._embed.vector(text)]

    def token_column(self, text):
        return None

    def describe(self):
        return f"lexical character 3-grams, {self.dim}-d, no model, semantic=false"


class LocalEmbedder:
    """A sentence-transformers model, loaded once per Python worker."""

    semantic = True

    def __init__(self, settings: Settings):
        try:
            import sentence_transformers  # noqa: F401
        except ImportError:
            raise RuntimeError(
                "embedding_backend=local needs sentence-transformers; set it to lexical to run "
                "without a model, with results labelled as not semantic"
            ) from None
        self._settings = settings
        self.name, self.dim = settings.embedding_model, settings.embedding_dim
        found = len(self.embed_query("dimension check"))
        if found != self.dim:
            raise ValueError(f"{self.name} makes {found}-d vectors, settings say {self.dim}")

    def _model(self):
        from sentence_transformers import SentenceTransformer

        return SentenceTransformer(self.name)

    def embed_passages(self, df, text, as_):
        s = self._settings

        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            from sentence_transformers import SentenceTransformer

            model = SentenceTransformer(s.embedding_model)
            for texts in batches:
                vectors = model.encode([s.passage_prefix + t for t in texts], batch_size=s.embedding_batch,
                                       normalize_embeddings=True, show_progress_bar=False)
                yield pd.Series(list(vectors))

        return df.withColumn(as_, embed(F.col(text)))

    def embed_query(self, text):
        s = self._settings
        return [float(x) for x in self._model().encode([s.query_prefix + text], normalize_embeddings=True)[0]]

    def token_column(self, text):
        s = self._settings

        @F.pandas_udf(T.IntegerType())
        def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            from sentence_transformers import SentenceTransformer

            tok = SentenceTransformer(s.embedding_model).tokenizer
            for texts in batches:
                yield pd.Series([len(tok(s.passage_prefix + t)["input_ids"]) for t in texts])

        return tokens(F.col(text))

    def describe(self):
        return f"local model {self.name}, {self.dim}-d, normalised, semantic=true"


Transport = Callable[[str, dict[str, str], dict], dict]


class RemoteEmbedder:
    """An embeddings endpoint, posted to in batches from the tasks."""

    semantic = True

    def __init__(self, settings: Settings, transport: Transport = post_json):
        if not settings.embedding_base_url:
            raise ValueError("embedding_backend=remote needs embedding_base_url")
        self.name, self.dim = settings.embedding_model, settings.embedding_dim
        self._url = settings.embedding_base_url.rstrip("/") + "/embeddings"
        self._headers = {"Authorization": f"Bearer {settings.embedding_api_key}"} if settings.embedding_api_key else {}
        self._settings, self._transport = settings, transport

    def _post(self):
        url, headers, name, send, s = self._url, self._headers, self.name, self._transport, self._settings

        def post(inputs):
            answer = insist(lambda: send(url, headers, {"model": name, "input": inputs}),
                            growing(s.publish_max_attempts, s.publish_backoff_seconds))
            return [_unit(row["embedding"]) for row in answer["data"]]

        return post

    def embed_passages(self, df, text, as_):
        """Null where the endpoint gives no vector after all attempts. A batch that fails is tried text by text, so
        one bad text costs itself alone."""
        post, size, prefix = self._post(), self._settings.embedding_batch, self._settings.passage_prefix

        def vectors(inputs):
            try:
                return post(inputs)
            except Exception:
                return [None] if len(inputs) == 1 else [v for i in inputs for v in vectors([i])]

        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                inputs = [prefix + t for t in texts]
                out = []
                for start in range(0, len(inputs), size):
                    out.extend(vectors(inputs[start:start + size]))
                yield pd.Series(out)

        return df.withColumn(as_, embed(F.col(text)))

    def embed_query(self, text):
        return self._post()([self._settings.query_prefix + text])[0]

    def token_column(self, text):
        return None  # the server's tokenizer is not ours to guess

    def describe(self):
        return f"remote {self.name}, {self.dim}-d, {self._url}, semantic=true"


BACKENDS: dict[str, Callable[[Settings], Embedder]] = {
    "local": LocalEmbedder, "remote": RemoteEmbedder, "lexical": LexicalEmbedder,
}


def get_embedder(settings: Settings) -> Embedder:
    backend = settings.embedding_backend.strip().lower()
    if backend not in BACKENDS:
        raise ValueError(f"unknown embedding backend {backend!r}: one of {', '.join(BACKENDS)}")
    return BACKENDS[backend](settings)
