"""Settings shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Spec:
    """Grid, season and horizon of a forecasting job.

    ``step`` is the grid step in seconds and must divide a day, so that bins
    start at midnight. ``period`` is the season length in steps. ``chunk`` is the
    number of steps one window partition covers: a long series is cut into
    chunks of that many steps and never lands in one task as a whole.
    """

    # Half-hour grid, one-day season, two-day horizon, week-long
    # average and week-long validation.
    step: int = 1800
    period: int = 48
    horizon: int = 96
    k_days: int = 7
    validation_days: int = 7
    chunk: int = 4096

    def __post_init__(self) -> None:
        if self.step <= 0 or 86400 % self.step:
            raise ValueError(f"step must divide a day, got {self.step} seconds")
        if min(self.period, self.horizon, self.validation_days, self.chunk) < 1 or self.k_days < 0:
            raise ValueError("period, horizon, validation_days and chunk must be positive")

    @property
    def validation_steps(self) -> int:
        return self.validation_days * self.period

    @property
    def min_backtest(self) -> int:
        """History a seasonal backtest needs: the validation days plus one."""
        return (self.validation_days + 1) * self.period


HALF_HOURLY = Spec()
HOURLY = Spec(step=3600, period=24, horizon=48)
DAILY = Spec(step=86400, period=7, horizon=14, k_days=4, validation_days=4)
