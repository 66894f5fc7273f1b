"""The closed catalog of block features and the columns that a selection of them needs."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DatasetError(ValueError):
    """A failed check, with the code that names it."""

    def __init__(self, code: str, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


@dataclass(frozen=True)
class Feature:
    """A column that a dataset can publish. implies: what checking it needs besides."""

    name: str
    kind: str  # Int64 or UTF-8
    unit: str
    implies: frozenset[str] = frozenset()
    positive: bool = False
    percentile: int | None = None


# Names, kinds, units and order are those of the published format.
_COLUMNS = """
timestamp                           Int64  unix_second
block_hash                          UTF-8  hex
parent_hash                         UTF-8  hex
base_fee_per_gas                    Int64  wei/gas
gas_used                            Int64  gas
gas_limit                           Int64  gas
tx_count                            Int64  transaction
effective_priority_fee_per_gas_p50  Int64  wei/gas
effective_priority_fee_per_gas_p90  Int64  wei/gas
"""
KEY = "block_number"
GAS = ("gas_used", "gas_limit")
#: Whatever is published, a block is identified, linked and dated.
ALWAYS = ("block_hash", "parent_hash", "timestamp")


def _feature(name: str, kind: str, unit: str) -> Feature:
    percentile = int(name.rpartition("_p")[2]) if "_fee_per_gas_p" in name else None
    implied = {"base_fee_per_gas", "gas_used"} if percentile else set(GAS) - {name} if name in GAS else set()
    return Feature(name, kind, unit, frozenset(implied), name in ("base_fee_per_gas", "gas_limit"), percentile)


#: By name, in the order in which a dataset publishes them.
BY_NAME = {f.name: f for f in (_feature(*line.split()) for line in _COLUMNS.strip().splitlines())}
CATALOG = tuple(BY_NAME.values())


@dataclass(frozen=True)
class Selection:
    """The features that a dataset publishes, in catalog order, and what follows from them."""

    names: tuple[str, ...]

    @classmethod
    def of(cls, wanted: list[str] | tuple[str, ...]) -> Selection:
        """The selection of some names, in whatever order they come; raises with all that is wrong with them."""
        counts = Counter(wanted)
        faults = [f"{n} is named {k} times" for n, k in counts.items() if k > 1]
        faults += [f"{n} is always there" if n == KEY else f"{n} is no feature" for n in counts if n not in BY_NAME]
        if faults or not counts:
            raise DatasetError("FEATURES_INVALID", "; ".join(faults) or "no feature is selected")
        return cls(tuple(n for n in BY_NAME if n in counts))

    @property
    def columns(self) -> tuple[str, ...]:
        return (KEY, *self.names)

    @property
    def percentiles(self) -> dict[str, int]:
        """The selected fee percentiles by column."""
        return {n: BY_NAME[n].percentile for n in self.names if BY_NAME[n].percentile is not None}

    @property
    def hidden(self) -> tuple[str, ...]:
        """Columns that checks need though they are not published."""
        needed = set(ALWAYS).union(*(BY_NAME[n].implies for n in self.names))
        return tuple(n for n in BY_NAME if n in needed.difference(self.names))

    @property
    def proofs(self) -> dict[str, str]:
        """Proof column -> the block's column that it repeats: always the identity, and both gas values with either."""
        found = {"_proof_hash": "block_hash", "_proof_parent_hash": "parent_hash", "_proof_timestamp": "timestamp"}
        gas = GAS if set(GAS) & set(self.names) else GAS[:1] if self.percentiles else ()
        return found | {f"_proof_{c}": c for c in gas}

    @property
    def schema(self) -> T.StructType:
        """The exact schema; units are in the fields' metadata."""
        features = [Feature(KEY, "Int64", "block"), *(BY_NAME[n] for n in self.names)]
        return T.StructType([T.StructField(f.name, T.LongType() if f.kind == "Int64" else T.StringType(), True, {"unit": f.unit}) for f in features])


def select_features(df: DataFrame, names: list[str] | tuple[str, ...], hidden: bool = False) -> DataFrame:
    """block_number and the named features in catalog order; with `hidden`, what their checks need too."""
    chosen = Selection.of(names)
    return df.select(*chosen.columns, *(chosen.hidden if hidden else ()))


def with_proofs(df: DataFrame, names: list[str] | tuple[str, ...], receipts: DataFrame | None = None) -> DataFrame:
    """The selection with its proof columns.

    With fee percentiles there is also _receipt_gas_used, the gas of the block's receipts (0 without
    any), which proves them complete; receipts (block_hash, gas_used) are needed for it.
    """
    chosen = Selection.of(names)
    proofs = {p: F.col(c) for p, c in chosen.proofs.items()}
    if chosen.percentiles:
        if receipts is None:
            raise DatasetError("PROOF_RECEIPTS", "fee percentiles are proved by receipts")
        sums = receipts.groupBy("block_hash").agg(F.sum("gas_used").alias("_receipt_gas_used"))
        df = df.join(sums, "block_hash", "left")
        proofs["_receipt_gas_used"] = F.coalesce("_receipt_gas_used", F.lit(0).cast("bigint"))
    return df.select(*chosen.columns, *(c.alias(p) for p, c in proofs.items()))


def without_proofs(df: DataFrame) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.startswith(("_proof_", "_receipt_"))))
