"""Keyed pseudonyms: HMAC-SHA256 composed from ``sha2``, so it stays in whole-stage codegen."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.text import strip

# Fixed value: hex characters kept of a digest, 128 bits.
PSEUDONYM_LENGTH = 32
_BLOCK = 64  # SHA-256 block size in bytes


class PrivacyError(RuntimeError):
    """Personal fields cannot be treated as the policy asks: a missing key or a faulty policy."""


class Pseudonymiser:
    """Stable pseudonyms under a secret key.

    The two HMAC pads are as good as the key, so they must not appear as literals in a plan (plans
    are logged and shown in UIs). They travel as a one-row table read by scalar subqueries.
    """

    def __init__(self, spark: SparkSession, key: str, version: str = "v1") -> None:
        if not key:
            raise PrivacyError("a pseudonym key is required")
        secret = key.encode("utf-8")
        if len(secret) > _BLOCK:
            secret = hashlib.sha256(secret).digest()
        secret = secret.ljust(_BLOCK, b"\0")
        self.version = version
        self._pads: DataFrame = spark.createDataFrame(
            [(bytearray(b ^ 0x36 for b in secret), bytearray(b ^ 0x5C for b in secret))],
            "inner_pad binary, outer_pad binary",
        )

    def column(self, value: Column) -> Column:
        """The pseudonym of ``value``; NULL for NULL or blank, which must not share an identity."""
        text = strip(value.cast("string"))
        inner = self._pads.select("inner_pad").scalar()
        outer = self._pads.select("outer_pad").scalar()
        first = F.sha2(F.concat(inner, text.cast("binary")), 256)
        second = F.sha2(F.concat(outer, F.unhex(first)), 256)
        return F.when(text != "", F.substring(second, 1, PSEUDONYM_LENGTH))
