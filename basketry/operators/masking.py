"""Token and feature-block masking by row hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.hashing import U32, as_col, unit
from .metrics import IGNORED

# Masking shares.
MASK_PROB = 0.15
TO_MASK = 0.8
TO_RANDOM = 0.1
BLOCK_DROP = 0.30


def masked_token(token: Column, pos: Column, row: Column, seed, *, mask_id: int, vocab_size: int,
                 specials: Sequence[int], prob: float = MASK_PROB, to_mask: float = TO_MASK,
                 to_random: float = TO_RANDOM) -> Column:
    """Struct (input_id, label) of one token. Specials are never chosen; a random replacement may be any id.

    One digest per position gives all three draws: its hex digits 1-8 choose, 9-16 act, 17-24
    name the replacement. Over exploded tokens this stays in generated code.
    """
    if not 0.0 < prob <= 1.0:
        raise ValueError(f"masking probability must lie in (0, 1]: {prob}")
    digest = F.sha1(F.concat_ws(":", as_col(seed).cast("string"), row.cast("string"), pos.cast("string")))
    draw = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    chosen = ~token.isin(*specials) & (draw(1) / F.lit(float(U32)) < prob)
    action = draw(9) / F.lit(float(U32))
    other = F.pmod(draw(17), F.lit(vocab_size)).cast("int")
    swapped = F.when(action < to_mask, F.lit(mask_id)).when(action < to_mask + to_random, other).otherwise(token)
    # One branch, so that unchosen positions cost a single hash.
    return F.when(chosen, F.struct(swapped.alias("input_id"), token.alias("label"))).otherwise(
        F.struct(token.alias("input_id"), F.lit(IGNORED).alias("label")))


def mask_tokens(ids: Column, row: Column, seed, **how) -> Column:
    """Array of (input_id, label) for an array of ids."""
    if not 0.0 < how.get("prob", MASK_PROB) <= 1.0:
        raise ValueError(f"masking probability must lie in (0, 1]: {how['prob']}")
    return F.transform(ids, lambda token, pos: masked_token(token, pos, row, seed, **how))


def dropped_blocks(row: Column, seed, names: Sequence[str], prob: float = BLOCK_DROP) -> Column:
    """Names of the blocks a row loses, each independently."""
    if not 0.0 <= prob <= 1.0:
        raise ValueError(f"drop probability must lie in [0, 1]: {prob}")
    return F.filter(
        F.array(*[F.when(unit(seed, row, n) < prob, F.lit(n)) for n in names]), lambda n: n.isNotNull())


def mask_blocks(features: Column, dropped: Column, blocks: Sequence[tuple[str, int, int]]) -> Column:
    """Zero the cells of dropped blocks; ``blocks`` is (name, start, length)."""
    parts = [
        F.when(F.array_contains(dropped, name), F.array_repeat(F.lit(0.0), length)).otherwise(
            F.slice(features, start + 1, length))
        for name, start, length in blocks if length > 0]
    return F.concat(*parts)
