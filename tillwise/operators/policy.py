"""Row-level access: which rows a set of roles may see."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowPolicy:
    """Admin roles see every row, other roles the rows with an allowed value."""

    column: str
    admins: frozenset[str]
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def predicate(self, roles: Iterable[str]) -> Column:
        held = set(roles)
        if held & self.admins:
            return F.lit(True)
        values = sorted({v for role in held for v in self.allowed.get(role, ())})
        if not values:
            return F.lit(False)
        return F.coalesce(F.col(self.column).isin(*values), F.lit(False))


# The regional policy on customers.
CUSTOMER_REGION = RowPolicy(
    "state", frozenset({"ADMIN"}), {"WEST_COAST_MANAGER": ("CA", "OR", "WA")})


def apply_row_policy(df: DataFrame, roles: Iterable[str], policy: RowPolicy = CUSTOMER_REGION) -> DataFrame:
    """Rows the roles may see; a plain predicate, so it is pushed to the scan."""
    return df.filter(policy.predicate(roles))


class GuardedTables:
    """Table accessor that applies policies before anything else can read a table."""

    def __init__(self, tables: Mapping[str, DataFrame], roles: Iterable[str], policies: Mapping[str, RowPolicy]):
        self._tables = dict(tables)
        self._roles = frozenset(roles)
        self._policies = dict(policies)

    def __getitem__(self, name: str) -> DataFrame:
        df = self._tables[name]
        policy = self._policies.get(name)
        return df if policy is None else apply_row_policy(df, self._roles, policy)

    def register_views(self) -> None:
        for name in self._tables:
            self[name].createOrReplaceTempView(name)
