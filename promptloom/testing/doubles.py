"""Test doubles for generation and embedding models, simple enough to restate in SQL."""

from __future__ import annotations

import json
import string

import numpy as np
import pandas as pd

LETTERS = string.ascii_lowercase


def echo_model():
    """Answers ``<length>:<prompt>``; a null or empty prompt has no answer."""

    def predict(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: f"{len(p)}:{p}" if p else None)

    return predict


def json_model(**fields):
    """A model whose answer is a JSON object; each field is computed from the prompt."""

    def factory():
        return lambda prompts: prompts.map(lambda p: json.dumps({k: f(p) for k, f in fields.items()}))

    return factory


def refusing_model(marker: str, inner=echo_model):
    """Fails every batch that holds a prompt containing ``marker``."""

    def factory():
        predict = inner()

        def call(prompts: pd.Series) -> pd.Series:
            if any(marker in p for p in prompts):
                raise RuntimeError("refused")
            return predict(prompts)

        return call

    return factory


def letter_encoder():
    """Counts of the letters a–z, scaled to length 1; a text without letters is all zeros."""

    def encode(texts: pd.Series) -> list:
        lowered = [t.lower() for t in texts]
        counts = np.array([[t.count(c) for c in LETTERS] for t in lowered], dtype=np.float64)
        norm = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        return list((counts / np.where(norm == 0, 1.0, norm)).astype(np.float32))

    return encode
