"""A keyed permutation of row numbers in column functions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F

ROUNDS = 6
WALKS = 64


def round_keys(seed: int) -> list[tuple[int, int]]:
    """A factor, odd and below 2^30, and an addend for each round."""
    found = []
    for i in range(ROUNDS):
        digest = hashlib.sha256(f"{seed}:{i}".encode()).digest()
        found.append((int.from_bytes(digest[:4], "big") >> 2 | 1, int.from_bytes(digest[4:8], "big") >> 2))
    return found


def permuted(index: Column, total: Column, seed: int) -> Column:
    """Where ``index`` of 0 to ``total`` - 1 goes in an order that ``seed`` alone decides.

    A Feistel network over the bits of the largest index: in turns each half is changed
    by a function of the other, which can be undone, so different indices stay different.
    A result beyond ``total`` goes through the network again until it is inside, which takes
    two passes on average. It does not depend on how rows are partitioned. ``total`` is at most 2^60.
    """
    bits = F.length(F.bin(total - 1))
    low = F.floor(bits / 2).cast("int")
    low_size, high_size = _power(low), _power(bits - low)

    def network(x: Column) -> Column:
        left, right = F.call_function("shiftright", x, low), F.pmod(x, low_size)
        state = F.struct(left.alias("left"), right.alias("right"))
        keys = F.array(*[F.struct(F.lit(n % 2).alias("turn"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for n, (a, b) in enumerate(round_keys(seed))])

        def step(s: Column, k: Column) -> Column:
            mixed = lambda half, size: F.pmod(F.shiftright(half * k["a"] + k["b"], 11), size)
            changed_right = s["right"].bitwiseXOR(mixed(s["left"], low_size))
            changed_left = s["left"].bitwiseXOR(mixed(s["right"], high_size))
            return F.struct(
                F.when(k["turn"] == 1, changed_left).otherwise(s["left"]).alias("left"),
                F.when(k["turn"] == 0, changed_right).otherwise(s["right"]).alias("right"),
            )

        return F.aggregate(keys, state, step, lambda s: s["left"] * low_size + s["right"])

    start = network(index.cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), start, lambda x, _: F.when(x < total, x).otherwise(network(x)))


def _power(bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bits.cast("int"))
