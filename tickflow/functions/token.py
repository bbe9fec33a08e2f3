"""Decoding of authenticated-encryption tokens with native expressions.

Token layout (public Fernet specification), base64url text of:
version byte 0x80 | 8-byte time | 16-byte IV | AES-128-CBC ciphertext | 32-byte HMAC-SHA256.
The 32-byte key is 16 bytes for signing, then 16 for encryption.
"""

from __future__ import annotations

import base64

from pyspark.sql import functions as F
from pyspark.sql.column import Column

from .scalar import bytes_to_text, col

_BLOCK = 64
_VERSION = "80"


def _split_key(key: str) -> tuple[bytes, bytes]:
    raw = base64.urlsafe_b64decode(key)
    if len(raw) != 32:
        raise ValueError("the key must be 32 bytes, base64url encoded")
    return raw[:16], raw[16:]


def _sha256(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def hmac_sha256(key: bytes, message: Column) -> Column:
    """HMAC from two nested hashes; the padded keys are constants of the plan."""
    padded = key.ljust(_BLOCK, b"\0")
    inner = F.lit(bytes(b ^ 0x36 for b in padded))
    outer = F.lit(bytes(b ^ 0x5C for b in padded))
    return _sha256(F.concat(outer, _sha256(F.concat(inner, message))))


def encode_token(text: Column | str, key: str, iv: Column, time: Column) -> Column:
    """Token for ``text``; ``iv`` is 16 bytes and ``time`` 8 bytes of binary."""
    sign, secret = _split_key(key)
    sealed = F.aes_encrypt(col(text).cast("binary"), F.lit(secret), F.lit("CBC"), F.lit("PKCS"), iv)
    body = F.concat(F.unhex(F.lit(_VERSION)), time, sealed)
    text64 = F.base64(F.concat(body, hmac_sha256(sign, body)))
    return F.translate(F.regexp_replace(text64, r"\s", ""), "+/", "-_").cast("binary")


def decode_token(value: Column | str, key: str | None) -> Column:
    """Plain text of a token; anything that is no valid token passes through as UTF-8."""
    value = col(value)
    plain = bytes_to_text(value)
    if not key:
        return plain
    sign, secret = _split_key(key)
    looks_like_token = plain.rlike(r"^gAAAA[A-Za-z0-9_\-]+={0,2}$")
    raw = F.when(looks_like_token & (F.length(plain) % 4 == 0),
                 F.unbase64(F.translate(plain, "-_", "+/")))

    def opened(token: Column) -> Column:
        size = F.octet_length(token)
        body = F.substring(token, F.lit(1), size - 32)
        mac = F.substring(token, size - 31, F.lit(32))
        sealed = F.substring(token, F.lit(10), size - 41)
        genuine = (size >= 73) & (hmac_sha256(sign, body) == mac)
        return F.when(genuine, F.try_aes_decrypt(sealed, F.lit(secret), F.lit("CBC"), F.lit("PKCS")))

    # an array of one binds the decoded bytes, so they are not decoded anew at every use
    return F.coalesce(F.get(F.transform(F.array(raw), opened), F.lit(0)).cast("string"), plain)
