"""Settings of the stages: defaults, overrides and the rules that they must meet."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from copy import deepcopy
from pathlib import Path

from lexflume.functions import text as X

#: What a run of the row features does when nothing else is said.
DEFAULTS: dict = {
    "input": {"id_column": "source_row_id", "representations": ["text_title_description", "Filtered_Text"], "reference_row_count": None},
    "validation": {"fail_on_severity": ["critical"], "row_count_warning_ratio": 0.25, "continue_with_available_representations": True},
    "audit": {"percentile": 0.95, "very_short_max_words": 3, "very_short_max_characters": 20},
    "features": {"representation_prefixes": {"text_title_description": "title_description", "Filtered_Text": "filtered_text"}, "currency_symbols": list(X.CURRENCY), "keyword_groups": X.KEYWORD_GROUPS},
}
SEVERITIES = ("info", "warning", "error", "critical")


def merged(base: Mapping, over: Mapping) -> dict:
    """base with over laid on it: mappings go key by key, all else is replaced; neither is changed."""
    both = {k: deepcopy(v) for k, v in base.items()}
    for k, v in over.items():
        both[k] = merged(both[k], v) if isinstance(both.get(k), Mapping) and isinstance(v, Mapping) else deepcopy(v)
    return both


def at(config: Mapping, path: str) -> object:
    """The value under a dotted path, None where there is none."""
    for part in path.split("."):
        config = config.get(part) if isinstance(config, Mapping) else None
    return config


def _name(x: object) -> bool:
    return isinstance(x, str) and bool(x.strip())


def _whole(x: object, least: int) -> bool:
    return isinstance(x, int) and not isinstance(x, bool) and x >= least


def _number(x: object) -> bool:
    return isinstance(x, int | float) and not isinstance(x, bool)


def _names(x: object) -> bool:
    return isinstance(x, list | tuple) and bool(x) and all(map(_name, x))


def _each_once(x) -> bool:
    return len(set(x)) == len(x)


def _prefixes(config: Mapping) -> list:
    own = at(config, "features.representation_prefixes")
    return [own.get(r) for r in at(config, "input.representations")] if isinstance(own, Mapping) else []


#: (setting, what it must be, test of the value and the whole configuration); later rules rely on earlier ones.
RULES: list[tuple[str, str, Callable[[object, Mapping], bool]]] = [
    ("input.id_column", "a name", lambda x, c: _name(x)),
    ("input.representations", "names, one at least", lambda x, c: _names(x)),
    ("input.representations", "without repeats", lambda x, c: _each_once(x)),
    ("input.reference_row_count", "a positive whole number or null", lambda x, c: x is None or _whole(x, 1)),
    ("validation.fail_on_severity", f"some of {SEVERITIES}", lambda x, c: isinstance(x, list | tuple) and bool(x) and set(x) <= set(SEVERITIES)),
    ("validation.row_count_warning_ratio", "0 or more", lambda x, c: _number(x) and x >= 0),
    ("audit.percentile", "above 0, 1 at most", lambda x, c: _number(x) and 0 < x <= 1),
    ("audit.very_short_max_words", "a whole number from 0", lambda x, c: _whole(x, 0)),
    ("audit.very_short_max_characters", "a whole number from 0", lambda x, c: _whole(x, 0)),
    ("features.representation_prefixes", "a prefix for each representation", lambda x, c: isinstance(x, Mapping) and all(map(_name, _prefixes(c)))),
    ("features.representation_prefixes", "different for each representation", lambda x, c: _each_once([p.strip() for p in _prefixes(c)])),
    ("features.currency_symbols", "signs, one at least", lambda x, c: isinstance(x, list | tuple) and bool(x) and all(isinstance(s, str) and s for s in x)),
    ("features.keyword_groups", "named groups of keywords", lambda x, c: isinstance(x, Mapping) and bool(x) and all(_name(k) and _names(v) for k, v in x.items())),
]
#: The same for the settings of a collection run.
COLLECTION_RULES: list[tuple[str, str, Callable[[object, Mapping], bool]]] = [
    ("source.name", "a name", lambda x, c: _name(x)),
    ("source.base_url", "an http address", lambda x, c: _name(x) and x.startswith(("http://", "https://"))),
    ("source.max_pages", "a whole number from 1", lambda x, c: _whole(x, 1)),
    ("http.allowed_hosts", "names, one at least", lambda x, c: _names(x)),
    ("http.user_agent", "a name", lambda x, c: _name(x)),
    ("http.delay_seconds", "0 or more", lambda x, c: _number(x) and x >= 0),
    ("filter.keywords", "names, one at least", lambda x, c: _names(x)),
    ("filter.required_matches", "a whole number from 1", lambda x, c: _whole(x, 1)),
]


def validate(config: Mapping, rules=RULES) -> None:
    """Raises ValueError at the first rule that isn't met."""
    for path, wanted, test in rules:
        if not test(at(config, path), config):
            raise ValueError(f"{path} must be {wanted}, not {at(config, path)!r}")


def parsed(text: str) -> object:
    """JSON, or YAML where PyYAML is there."""
    try:
        import yaml
    except ImportError:
        return json.loads(text or "{}")
    return yaml.safe_load(text)


def load(path: str | Path | None = None, defaults: Mapping = DEFAULTS, rules=RULES) -> dict:
    own = {} if path is None else parsed(Path(path).read_text(encoding="utf-8")) or {}
    if not isinstance(own, Mapping):
        raise TypeError("settings must be a mapping")
    config = merged(defaults, own)
    validate(config, rules)
    return config
