"""Encrypted columns, as kept for passwords in task tables.

Layout of a stored value: base64 of a 16-byte random IV followed by the AES-CBC
ciphertext with PKCS padding. The key (16, 24 or 32 bytes) is the caller's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encrypt_column(value: Column, key: Column) -> Column:
    return F.base64(F.aes_encrypt(value, key, F.lit("CBC"), F.lit("PKCS")))


def decrypt_column(value: Column, key: Column) -> Column:
    return F.aes_decrypt(F.unbase64(value), key, F.lit("CBC"), F.lit("PKCS")).cast("string")
