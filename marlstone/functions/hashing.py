"""Hashes that place rows on shards and split tables.

Values must equal those of rows that are placed already, so the hash functions are the published ones: MurmurHash3
x64 128 (first half, little-endian), triple DES with a null key on one block, and the 31-polynomial of bytes that starts
with their number. Columns go through Arrow UDFs that hash a batch's distinct values once; the engine hashes
literals of a predicate on the driver and prunes partitions by the results.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable, Sequence
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from marlstone.plans.errors import SqlError
from marlstone.shipping import ship

_64 = (1 << 64) - 1
#: Multipliers of MurmurHash3 x64 128; fixed values.
_C1, _C2 = 0x87C37B91114253D5, 0x4CF5AD432745937F


def _rotate(x: int, n: int) -> int:
    return ((x << n) | (x >> (64 - n))) & _64


def _finish(x: int) -> int:
    x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & _64
    x = ((x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53) & _64
    return x ^ (x >> 33)


def murmur3_128(data: bytes) -> int:
    """The first 64 bits, as a signed number, with seed 0."""
    a = b = 0
    whole = len(data) // 16 * 16
    for at in range(0, whole, 16):
        k1 = int.from_bytes(data[at : at + 8], "little")
        k2 = int.from_bytes(data[at + 8 : at + 16], "little")
        a = (_rotate(a ^ (_rotate(k1 * _C1 & _64, 31) * _C2 & _64), 27) + b) * 5 + 0x52DCE729 & _64
        b = (_rotate(b ^ (_rotate(k2 * _C2 & _64, 33) * _C1 & _64), 31) + a) * 5 + 0x38495AB5 & _64
    tail = data[whole:]
    b ^= _rotate(int.from_bytes(tail[8:], "little") * _C2 & _64, 33) * _C1 & _64
    a ^= _rotate(int.from_bytes(tail[:8], "little") * _C1 & _64, 31) * _C2 & _64
    a ^= len(data)
    b ^= len(data)
    a = a + b & _64
    b = b + a & _64
    a, b = _finish(a), _finish(b)
    a = a + b & _64
    return a - (1 << 64) if a >> 63 else a


@lru_cache(maxsize=1)
def _crypto() -> ctypes.CDLL:
    path = ctypes.util.find_library("crypto")
    if not path:
        raise SqlError("keyspace ids need the crypto library of OpenSSL")
    lib = ctypes.CDLL(path)
    for name in ("EVP_CIPHER_CTX_new", "EVP_des_ede3_ecb"):
        getattr(lib, name).restype = ctypes.c_void_p
    return lib


def null_key_encrypt(blocks: bytes) -> bytes:
    """Triple DES of each 8-byte block, with a key of zeros."""
    lib = _crypto()
    ctx = ctypes.c_void_p(lib.EVP_CIPHER_CTX_new())
    try:
        out, n = ctypes.create_string_buffer(len(blocks) + 8), ctypes.c_int()
        if not lib.EVP_EncryptInit_ex(ctx, ctypes.c_void_p(lib.EVP_des_ede3_ecb()), None, bytes(24), None):
            raise SqlError("the crypto library has no triple DES")
        lib.EVP_CIPHER_CTX_set_padding(ctx, 0)
        lib.EVP_EncryptUpdate(ctx, out, ctypes.byref(n), blocks, len(blocks))
        return out.raw[: len(blocks)]
    finally:
        lib.EVP_CIPHER_CTX_free(ctx)


def index_of(value: Any) -> int:
    """The number that stands for a key: an integer itself; of other values, an unsigned 64-bit number that their
    text writes, else the hash of the text, trimmed and in lower case."""
    if isinstance(value, int) and not isinstance(value, bool):
        return int(value)
    text = value.decode() if isinstance(value, bytes) else str(value)
    if text.isascii() and text.isdigit() and int(text) <= _64:
        return int(text)
    return murmur3_128(text.strip().lower().encode())


def keyspace_ids(values: Sequence[Any]) -> list[bytes]:
    if not values:
        return []
    blocks = b"".join((index_of(v) & _64).to_bytes(8, "big") for v in values)
    out = null_key_encrypt(blocks)
    return [out[i : i + 8] for i in range(0, len(out), 8)]


def shard_bounds(shards: Sequence[str]) -> list[tuple[bytes, bytes]]:
    """First and last (exclusive) keyspace id of shards that are named like -40, 40-80 and 80-."""
    out = []
    for name in shards:
        first, dash, last = name.partition("-")
        if not dash and name not in ("0", ""):
            raise SqlError(f"a shard's name has to be a range: {name!r}")
        out.append((bytes.fromhex(first) if dash else b"", bytes.fromhex(last) if dash else b""))
    return out


def shards_of(values: Sequence[Any], shards: Sequence[str]) -> list[int]:
    """The number of the first shard whose range has each key's id."""
    bounds = shard_bounds(shards)
    out = []
    for k in keyspace_ids(values):
        found = next((i for i, (a, b) in enumerate(bounds) if a <= k and (not b or k < b)), None)
        if found is None:
            raise SqlError(f"KeyspaceId {k.hex()} didn't match any shards {list(shards)}")
        out.append(found)
    return out


def even_shards(n: int) -> list[str]:
    """Names of n ranges of equal size, n a power of two up to 256."""
    if n == 1:
        return ["-"]
    edges = [f"{i * 256 // n:02x}" for i in range(1, n)]
    return [f"-{edges[0]}", *(f"{a}-{b}" for a, b in zip(edges, edges[1:], strict=False)), f"{edges[-1]}-"]


def key_text(value: Any) -> bytes:
    return value if isinstance(value, bytes) else str(value).encode()


def split_by_murmur(value: Any, n: int) -> int:
    return abs(murmur3_128(key_text(value))) % n


def split_by_polynomial(value: Any, n: int) -> int:
    """Remainder of the 31-polynomial of the key's bytes (signed), which starts with their number, in 32 bits."""
    data = key_text(value)
    h = len(data)
    for b in data:
        h = (h * 31 + (b - 256 if b > 127 else b)) & 0xFFFFFFFF
    h = h - (1 << 32) if h >> 31 else h
    return abs(h or 1) % n


def split_by_long(value: Any, n: int) -> int:
    return abs(int(value)) % n


#: Split algorithms by their names in rules. More can be added: a function from a key and the number of tables.
ALGORITHMS: dict[str, Callable[[Any, int], int]] = {"ShardTableByMurmur": split_by_murmur, "TableRuleMod": split_by_polynomial, "ShardTableByLong": split_by_long}


def _each_distinct(of: Callable[[list], list[int]], keys: pa.Array) -> pa.Array:
    coded = keys.dictionary_encode()
    numbers = pa.array(of(coded.dictionary.to_pylist()), pa.int32())
    return numbers.take(coded.indices)


def shard_column(key: Column, shards: Sequence[str]) -> Column:
    """The shard's number; null for a null key."""
    ship(SparkSession.active())

    @F.arrow_udf("int")
    def shard(keys: pa.Array) -> pa.Array:
        return _each_distinct(lambda values: shards_of(values, shards), keys)

    return shard(key)


def split_column(key: Column, algorithm: str, n: int) -> Column:
    function = ALGORITHMS[algorithm]
    ship(SparkSession.active())

    @F.arrow_udf("int")
    def split(keys: pa.Array) -> pa.Array:
        return _each_distinct(lambda values: [function(v, n) for v in values], keys)

    return split(key)
