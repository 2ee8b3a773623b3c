"""The attribution as a chain of lazily built DataFrame stages.

Each property is one operator of the chain; stages are built on first use and
shared, so a caller asking for several stages builds the common prefix once.
The flagship scans the export once (``roles``, pinned); an ordered stage counts
its rows per key when it is built (plans.chunked), everything else stays lazy
until an action.
"""

from __future__ import annotations

from functools import cached_property, wraps

from pyspark.sql import DataFrame

from ..config import DEFAULT_CONFIG, AttributionConfig
from ..operators import conversions, cycles, events, identity, models, roles, sessions, touchpoints, weights
from ..plans import chunked as ck


def _stage(build):
    """A stage built once, whose cached rounds belong to the instance."""

    @wraps(build)
    def owned(self):
        with ck.owned_by(self.rounds):
            return build(self)

    return cached_property(owned)


class Attribution:
    """The stages of one attribution run.

    Only users cut into chunks have cached rounds; the last one stays for the
    result's readers until ``close()``, and is recomputed from pinned rows then.
    """

    def __init__(self, export: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG):
        self.export = export
        self.cfg = cfg
        self.rounds = ck.Rounds()

    def close(self) -> None:
        """Release the cached rows; every DataFrame made from the stages stays valid."""
        self.rounds.retire()

    def __enter__(self) -> "Attribution":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    @_stage
    def events(self) -> DataFrame:
        return events.normalize_events(self.export)

    @_stage
    def ids(self) -> DataFrame:
        return identity.stitch_identities(self.events)

    @_stage
    def roles(self) -> DataFrame:
        """The export's one scan for the attribution, pinned: session starts, conversions and logins."""
        return ck.checkpoint(roles.role_rows(self.export, self.cfg))

    @_stage
    def logins(self) -> DataFrame:
        """pseudo id -> login (logged-in pseudo ids only); read by both blends."""
        return identity.login_map(identity.last_logins(roles.login_rows(self.roles)))

    @_stage
    def heavy(self) -> dict[str, ck.Heavy | None]:
        """Keys with more than ``chunk_rows`` session starts, for the stages and joins that deal them by key."""
        starts = roles.start_rows(self.roles)
        visitors = sessions.visitor_counts(starts)
        return ck.heavy_by_kind(
            {"visitor": visitors, "user": identity.user_counts(visitors, self.logins),
             "session": sessions.session_counts(starts)}, self.cfg.chunk_rows, starts)

    @_stage
    def heavy_converters(self) -> dict[str, ck.Heavy | None]:
        """The same of conversions: visitors and the users they belong to."""
        converting = roles.conversion_rows(self.roles)
        visitors = sessions.visitor_counts(converting)
        return ck.heavy_by_kind({"visitor": visitors, "user": identity.user_counts(visitors, self.logins)},
                                self.cfg.chunk_rows, converting)

    @_stage
    def sessions(self) -> ck.Ordered:
        """Distinct session rows with ends and ``_mult``, dealt by pseudo id."""
        return sessions.with_session_end(roles.start_rows(self.roles), self.cfg, self.heavy["visitor"])

    @_stage
    def blended_sessions(self) -> DataFrame:
        return identity.blend_ordered(self.sessions, self.logins)

    @_stage
    def conversion_candidates(self) -> DataFrame:
        """Order and registration events with blended ids, only the columns that are scored."""
        return identity.blend_users(roles.conversion_rows(self.roles), self.logins, self.logins,
                                    self.heavy_converters["visitor"])

    @_stage
    def converting_events_filtered(self) -> DataFrame:
        """O10 with every event column; ``converting_events`` does not read it."""
        wide = conversions.conversion_candidates(self.events, self.ids, self.cfg, self.logins)
        return conversions.select_converting_events(wide, self.cfg)

    @_stage
    def converting_events(self) -> DataFrame:
        return conversions.score_conversions(
            conversions.select_converting_events(self.conversion_candidates, self.cfg,
                                                  self.heavy_converters["user"]), self.cfg)

    @_stage
    def converting_sessions(self) -> DataFrame:
        return conversions.rollup_conversions(self.converting_events, self.cfg)

    @_stage
    def touchpoints_chunked(self) -> ck.Ordered:
        return touchpoints.label_touchpoints_chunked(self.blended_sessions, self.converting_sessions, self.cfg,
                                                     self.heavy)

    @_stage
    def running(self) -> ck.Ordered:
        return cycles.running_conversions(self.touchpoints_chunked, weights.day_session_counts(self.cfg))

    @_stage
    def cycles(self) -> ck.Ordered:
        return cycles.conversion_cycles(self.running)

    @_stage
    def lookback(self) -> ck.Ordered:
        return cycles.lookback_windows(self.cycles, self.cfg)

    @_stage
    def time_decay(self) -> ck.Ordered:
        return weights.time_decay_scores(self.lookback, self.cfg)

    @_stage
    def channel_flags(self) -> ck.Ordered:
        return weights.cycle_channel_flags(weights.cycle_stats(self.time_decay, self.cfg))

    @_stage
    def weights(self) -> ck.Ordered:
        return weights.model_weights(self.channel_flags, self.cfg)

    @_stage
    def result(self) -> DataFrame:
        return models.attribution_long(self.weights.rows(), self.cfg)

    def stage(self, name: str) -> DataFrame:
        """A stage's rows without internal columns."""
        found = getattr(self, name)
        return found.rows() if isinstance(found, ck.Ordered) else ck.drop_internal(found)


def attribution(export: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG) -> DataFrame:
    """The long-form multi-model attribution of an export."""
    return Attribution(export, cfg).result
