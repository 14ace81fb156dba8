"""Scoring a stream of ratings with a fitted effect model.

The reference is batch only (no watermark, window or state).  The one thing it
does with new (user, movie) pairs is predict them, and that operator is the
same DataFrame plan on a streaming source: every effect table is a static,
size-checked relation, so each micro-batch runs stream-static left joins and
no state is kept.
"""

from ratecraft.streaming.scoring import predict_stream

__all__ = ["predict_stream"]
