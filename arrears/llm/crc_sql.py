"""CRC-32 as SQL, which has no function for it."""

from __future__ import annotations


def step(value: int, bits: int) -> int:
    """The remainder after ``bits`` zero bits (reflected polynomial 0xEDB88320)."""
    for _ in range(bits):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


NIBBLES = [step(n, 4) for n in range(16)]


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of the UTF-8 bytes of the SQL expression ``text``: two half bytes at a time."""
    after = "xor(CAST(crc AS BIGINT) >> 4, {t}[(xor(CAST(crc AS BIGINT), x) & 15) + 1])".format(t=NIBBLES)
    halves = (
        f"flatten(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda two: "
        "[CAST('0x' || two[2] AS BIGINT), CAST('0x' || two[1] AS BIGINT)]))"
    )
    return f"xor(list_reduce({halves}, lambda crc, x: {after}, CAST(4294967295 AS BIGINT)), 4294967295)"
