"""End of a run: enrolment and ownership are settled over the node and edge tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from meterspark.operators import graph


@dataclass(frozen=True)
class Settled:
    devices: DataFrame
    upods: DataFrame
    edges: DataFrame


def start_run(devices: DataFrame) -> DataFrame:
    """Devices as a run finds them: none of the provider's is enrolled until the run has seen it."""
    return graph.enrolment_reset(devices)


def end_run(devices: DataFrame, upods: DataFrame, edges: DataFrame,
            logins: DataFrame,
            keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> Settled:
    """Settle a run. Doing so twice gives the same tables.

    `devices` is `(uri, source, enrolled, stateCancelled, endDate, props)`, `upods`
    `(uri, endDate, newSupply)`, `edges` `(src, type, dst)`, `logins` `(uri, username)`.
    All three results build on the links that end; `keep` may store those, for instance by
    `lambda df: df.checkpoint()`, so that they are found once.
    """
    ended = keep(graph.ended_links(edges, graph.nif_props_map(devices), logins))
    settled = graph.strip_nif_props(
        graph.resolve_enddates(graph.finalize_enrolment(devices), ended, edges))
    return Settled(settled,
                   graph.default_new_supply(graph.resolve_enddates(upods, ended, edges)),
                   graph.resolve_ownership(edges, ended))
