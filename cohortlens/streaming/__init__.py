"""Structured Streaming operators."""

from .kmeans import StreamingKMeansState, run_streaming_kmeans

__all__ = ["StreamingKMeansState", "run_streaming_kmeans"]
