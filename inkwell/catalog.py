"""All registered queries of the library, without the training-data operators."""

from __future__ import annotations

from .queries import dataset, evaluation, files, layout, scores, sequences, text, web
from .registry import oracles, queries

__all__ = ["dataset", "evaluation", "files", "flagship", "layout", "oracles", "queries", "scores", "sequences", "text", "web"]

flagship = scores.score_winners
