"""Fixed-width character-sequence encoding as a native higher-order function.

No Python worker is involved: ``transform`` over ``sequence(1, width)`` runs
in the JVM next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Vocabulary of the sequence encoder: character k (1-based) of this string maps
# to id k; anything else, and padding, map to 0. Width 20.
VOCABULARY = "abcdefghijklmnopqrstuvwxyz0123456789!@#$%^&*()_+-=[]{}|;:',.<>/?"
PAD_ID = 0
WIDTH = 20
# ---------------------------------------------------------------------------

VOCAB_SIZE = len(VOCABULARY) + 1  # ids 0..64


def encode(password: str | Column = "password", width: int = WIDTH,
           vocabulary: str = VOCABULARY, cased: bool = False,
           unknown_id: int | None = None) -> Column:
    """ARRAY<INT> of length ``width``: lower-cased (unless ``cased``), cut at
    ``width`` characters, mapped through ``vocabulary``, right-padded with 0.
    NULL encodes as all zeros. Characters outside the vocabulary map to 0
    like padding, or to ``unknown_id`` when it is given (e.g. ``VOCAB_SIZE``)
    so a model can tell them from padding."""
    p = F.col(password) if isinstance(password, str) else password
    s = F.coalesce(p, F.lit(""))
    if not cased:
        s = F.lower(s)
    vocab = F.lit(vocabulary)

    def at(i: Column) -> Column:
        idx = F.instr(vocab, F.substring(s, i, 1))
        if unknown_id is not None:
            idx = F.when(idx == 0, F.lit(unknown_id)).otherwise(idx)
        return F.when(i <= F.length(s), idx).otherwise(F.lit(PAD_ID)).cast("int")

    return F.transform(F.sequence(F.lit(1), F.lit(width)), at)


def position(col: str, i: int, vocabulary: str = VOCABULARY) -> Column:
    """Entry ``i`` of the encoding as a column of its own (stays in generated
    code, where the array form runs element by element)."""
    c = F.coalesce(F.col(col), F.lit(""))
    ch = F.substring(F.lower(c), i + 1, 1)
    return F.when(ch == "", 0).otherwise(F.instr(F.lit(vocabulary), ch)).cast("int")
