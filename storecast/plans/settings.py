"""What a job run takes: a few values of its own and the parameters of each operator."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping
from dataclasses import dataclass, field

from ..config import MARKDOWNS
from ..operators.features import BANDS
from ..operators.forecast import ForecastParams
from ..operators.quality import Limits
from ..operators.rules import RuleParams
from ..operators.seasonal import SeasonalParams
from ..operators.segment import SegmentParams
from ..sources.csv import FILES


@dataclass(frozen=True)
class Config:
    split_date: str = "2012-01-01"
    fill: str = "chronological"
    zscore: float = 3.0
    bands: tuple[float, ...] = BANDS
    markdowns: tuple[str, ...] = MARKDOWNS
    files: Mapping[str, str] = field(default_factory=lambda: dict(FILES))
    limits: Limits = field(default_factory=Limits)
    segments: SegmentParams = SegmentParams()
    forecast: ForecastParams = ForecastParams()
    rules: RuleParams = RuleParams()
    seasonal: SeasonalParams = SeasonalParams()

    @classmethod
    def from_dict(cls, raw: Mapping) -> "Config":
        """Values by field name; an operator's parameters are a nested mapping, of
        which those not named keep their defaults. An unknown name is an error."""
        return _merged(cls(), raw)


def _merged(base, given: Mapping):
    names = {f.name for f in dataclasses.fields(base)}
    if unknown := sorted(set(given) - names):
        raise ValueError(f"{type(base).__name__} has no {unknown}")
    changes = {}
    for name, value in given.items():
        old = getattr(base, name)
        if dataclasses.is_dataclass(old):
            value = _merged(old, value or {})
        elif isinstance(old, Mapping):
            value = {**old, **value}
        elif isinstance(value, list):
            value = tuple(value)
        changes[name] = value
    return dataclasses.replace(base, **changes)


def load_config(path: str | None = None) -> Config:
    """The defaults, or those with the values of a YAML file put over them."""
    if path is None:
        return Config()
    import yaml

    with open(path, encoding="utf-8") as fh:
        return Config.from_dict(yaml.safe_load(fh) or {})
