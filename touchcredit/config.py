"""Attribution parameters.

Every literal of the attribution workload is a field here, so event names,
windows and channel rules are configuration rather than code.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed values that must equal the workload's defaults for matching results:
# the session marker event, the registration and order event names, the
# look-back window (30 days), the time-decay window and divisor (7 days, 7),
# the source values that count as "direct" ("(direct)", "(data deleted)",
# "<other>", compared lower-cased), the LIKE pattern for paid media ("%paid%")
# and the day-number epoch (2018-01-01).
DEFAULT_SESSION_EVENT = "session_start"
DEFAULT_REGISTRATION_EVENT = "Form Submitted"
DEFAULT_ORDER_EVENT = "file_download"
DEFAULT_LOOKBACK_DAYS = 30
DEFAULT_TIME_DECAY_DAYS = 7
DEFAULT_TIME_DECAY_DIVISOR = 7.0
DEFAULT_DIRECT_SOURCES = ("(direct)", "(data deleted)", "<other>")
DEFAULT_PAID_MEDIUM_PATTERN = "%paid%"
DEFAULT_EPOCH_DATE = "2018-01-01"

DEFAULT_CHUNK_ROWS = 1 << 18

# Model labels, in the order the models are emitted.
LAST_CLICK = "Last Click"
FIRST_CLICK = "First Click"
LAST_NON_DIRECT = "Last Non-Direct Click"
FIRST_PAID = "First Paid Click"
LAST_PAID = "Last Paid Click"
LINEAR = "Linear"
TIME_DECAY = "Time Decay"
FIRST_NON_DIRECT = "First Non-Direct Click"

# label -> weight column produced by operators.weights
MODEL_WEIGHTS = {
    LAST_CLICK: "last_click_attrib_pct",
    FIRST_CLICK: "first_click_attrib_pct",
    LAST_NON_DIRECT: "last_non_direct_click_attrib_pct",
    FIRST_PAID: "first_paid_click_attrib_pct",
    LAST_PAID: "last_paid_click_attrib_pct",
    LINEAR: "even_click_attrib_pct",
    TIME_DECAY: "time_decay_attrib_pct",
    FIRST_NON_DIRECT: "first_non_direct_click_attrib_pct",
}

DEFAULT_MODELS = (LAST_CLICK, FIRST_CLICK, LAST_NON_DIRECT, FIRST_PAID, LAST_PAID, LINEAR, TIME_DECAY)


@dataclass(frozen=True)
class AttributionConfig:
    session_event: str = DEFAULT_SESSION_EVENT
    registration_event: str = DEFAULT_REGISTRATION_EVENT
    order_event: str = DEFAULT_ORDER_EVENT
    lookback_days: int = DEFAULT_LOOKBACK_DAYS
    time_decay_days: int = DEFAULT_TIME_DECAY_DAYS
    time_decay_divisor: float = DEFAULT_TIME_DECAY_DIVISOR
    # False: only non-converting sessions are eligible for credit: they alone
    # are candidates of the click models and denominators of the others.  A
    # cycle without an eligible session credits nobody.
    include_conversion_session: bool = True
    direct_sources: tuple[str, ...] = DEFAULT_DIRECT_SOURCES
    paid_medium_pattern: str = DEFAULT_PAID_MEDIUM_PATTERN
    epoch_date: str = DEFAULT_EPOCH_DATE
    # "reference": score 2^(days-1) grows with age (the workload's behaviour);
    # "recent": score 2^(-days), more credit to recent sessions.
    time_decay_direction: str = "reference"
    # "session": conversions roll up and join on session_id alone (the
    # workload's behaviour); "user_session": on (blended user, session_id).
    session_key: str = "session"
    models: tuple[str, ...] = field(default=DEFAULT_MODELS)
    # Rows of one user that stay together in the ordered stages; a user with
    # more is cut into chunks of about that many.  Results never depend on it.
    chunk_rows: int = DEFAULT_CHUNK_ROWS

    def __post_init__(self) -> None:
        if self.time_decay_direction not in ("reference", "recent"):
            raise ValueError(f"time_decay_direction: {self.time_decay_direction!r}")
        if self.session_key not in ("session", "user_session"):
            raise ValueError(f"session_key: {self.session_key!r}")
        if self.chunk_rows < 1:
            raise ValueError(f"chunk_rows: {self.chunk_rows!r}")
        unknown = [m for m in self.models if m not in MODEL_WEIGHTS]
        if unknown:
            raise ValueError(f"unknown models: {unknown}")

    def with_(self, **kw) -> "AttributionConfig":
        return replace(self, **kw)


DEFAULT_CONFIG = AttributionConfig()
