"""Tenant isolation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ScopeError(PermissionError):
    """Access outside the tenant or scope of the caller."""


@dataclass(frozen=True)
class OrgContext:
    organization_id: str
    scopes: frozenset[str] = field(default_factory=frozenset)

    def __post_init__(self) -> None:
        if not self.organization_id or not self.organization_id.strip():
            raise ScopeError("organization_id is required")

    @property
    def is_admin(self) -> bool:
        return "admin" in self.scopes

    def require(self, scope: str) -> None:
        if scope not in self.scopes and not self.is_admin:
            raise ScopeError(f"Missing required scope: {scope}")


def org_scope(
    df: DataFrame, ctx: OrgContext, scope: str | None = None, org_col: str = "organization_id"
) -> DataFrame:
    """Only the caller's rows; a frame without a tenant column is refused.

    An ``admin`` scope sees all tenants.
    """
    if scope:
        ctx.require(scope)
    if org_col not in df.columns:
        raise ScopeError(f"frame has no {org_col} column")
    return df if ctx.is_admin else df.filter(F.col(org_col) == ctx.organization_id)


def org_scoped(
    operator: Callable[..., DataFrame], df: DataFrame, ctx: OrgContext, *args, **kwargs
) -> DataFrame:
    """Any search over the caller's rows only."""
    return operator(org_scope(df, ctx), *args, **kwargs)
