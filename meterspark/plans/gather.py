"""From subscriptions to routed supplies, requests, chunk state and published messages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, functions as F

from meterspark.functions.skew import salted_join
from meterspark.operators import chunks, readings as R, routing, supplies as S
from meterspark.sources.subscriptions import SourceSpec
from meterspark.streaming import envelopes as E


@dataclass(frozen=True)
class Requests:
    """What a run asks the provider for."""

    routed: DataFrame
    state: DataFrame
    plan: DataFrame


def plan_requests(subscriptions: DataFrame, supplies: DataFrame, state: DataFrame,
                  as_of: date) -> Requests:
    """Route every supply and list the chunks still worth requesting.

    A supply reachable through several logins has one chunk history and is asked for once per
    login, as routed. Supplies that go to no source are not requested and lose no retry.
    """
    routed = routing.route_supplies(routing.login_sources(subscriptions), supplies)
    owned = (chunks.by_meter(routed.filter(F.size("db_list") > 0).select("cups", "validDateTo", "seq"))
             .groupBy("cups").agg(F.max_by("validDateTo", "seq").alias("validDateTo")))
    calendar = chunks.chunk_calendar(owned, as_of)
    tracked = chunks.tracked_state(calendar, state)
    return Requests(routed, tracked, chunks.request_plan(tracked, routed, as_of))


@dataclass(frozen=True)
class Delivery:
    """What a run makes of the readings it got."""

    state: DataFrame
    timeseries: DataFrame
    static: DataFrame


def send(delivery: Delivery, run_id: str, static_topic: str, write: Callable[[DataFrame], None],
         partitions: int = 1) -> None:
    """Write a delivery's messages, and when they are written the end of the run: a marker for each
    partition of the static topic. `write` sends messages (`topic, key, value`)."""
    write(delivery.timeseries)
    write(delivery.static)
    runs = delivery.static.sparkSession.createDataFrame([(run_id,)], "run_id string")
    write(E.final_markers(runs, static_topic, partitions))


def deliver(requests: Requests, delivered: DataFrame, contracts: DataFrame,
            specs: list[SourceSpec], as_of: date, static_topic: str, run_id: str = "",
            order: tuple[str, ...] = ("seq",)) -> Delivery:
    """Update the chunk state from delivered readings and publish readings and supplies.

    Each source gets the readings of the supplies routed to it, on its own topic. A reading that came
    more than once, through several logins for instance, counts once. The state returned is that of
    the tracked chunks; `chunk_state_upsert` puts it into the stored table.
    """
    unique = R.latest_readings(delivered, list(order))
    state = chunks.retry_state(requests.state, chunks.chunk_observed(unique, as_of), as_of)
    wanted = (requests.routed.select("cups", F.explode("db_list").alias("source"))
              .groupBy("cups").agg(F.sort_array(F.collect_set("source")).alias("sources")))
    timeseries = E.publish_envelopes(
        salted_join(unique, wanted, ["cups"], ["timestamp"], how="inner", counted=delivered),
        specs, run_id)
    records = (S.supply_contract_merge(requests.routed.withColumn("nif", F.col("username")),
                                       S.latest_contract(contracts))
               .join(chunks.supply_measurements(requests.state, as_of), "cups", "left"))
    return Delivery(state, timeseries, E.publish_static(records, static_topic, run_id, specs))
