"""Column roles of a table that holds many time series."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SeriesSpec:
    """Which column plays which role.

    ``keys`` identify a series, ``time`` orders it, ``step`` is the length of
    one grid step in seconds (None: not regular yet).
    """

    keys: tuple[str, ...]
    time: str
    target: tuple[str, ...] = ()
    past: tuple[str, ...] = ()
    future: tuple[str, ...] = ()
    static: tuple[str, ...] = ()
    step: int | None = field(default=None)

    @property
    def values(self) -> tuple[str, ...]:
        seen: dict[str, None] = {}
        for c in (*self.target, *self.past, *self.future):
            seen.setdefault(c)
        return tuple(seen)


ELECTRICITY = SeriesSpec(
    keys=("unique_id",),
    time="ds",
    target=("y",),
    past=("Exogenous1", "Exogenous2"),
    future=("Exogenous1", "Exogenous2"),
    static=("unique_id",),
    step=3600,
)

BATTERY = SeriesSpec(
    keys=("battery_id",),
    time="datetime_",
    target=("Time", "Capacity"),
    past=("Voltage_measured", "Current_measured", "Temperature_measured"),
    future=("Voltage_measured", "Current_measured", "Temperature_measured"),
)
