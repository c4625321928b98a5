"""concord: federated text-classification analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    table readers, derived source encodings, CSV / JSON / binary I/O
functions  scalar column helpers (hashing, names, base64, JSON)
operators  DataFrame -> DataFrame building blocks (corpus, averaging,
           rounds, model, evaluate)
plans      end-to-end jobs composed from operators
streaming  Structured Streaming forms of the round controller
"""

__all__ = ["session"]
