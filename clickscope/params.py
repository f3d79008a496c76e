"""Run parameters of the batch jobs (dates, user filters, page flow, sampling)."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass


def _csv(value: str | None) -> tuple[str, ...] | None:
    """Split a csv parameter; ``None`` or an empty string means "no filter"."""
    if value is None:
        return None
    items = tuple(v.strip() for v in str(value).split(",") if v.strip() != "")
    return items or None


@dataclass(frozen=True)
class TaskParams:
    """Parameters of one analysis run.

    Empty / ``None`` filters are not applied.  Dates are inclusive ``yyyy-MM-dd``
    strings compared with the ``date`` column of the visit log.
    """

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: str | None = None
    cities: str | None = None
    sex: str | None = None
    keywords: str | None = None
    category_ids: str | None = None
    target_page_flow: str = "1,2,3,4,5,6,7"
    # stratified session sample: total sessions to draw over all days
    sample_size: int = 100
    # seed prepended to the session id before hashing; fixes the sample
    sample_seed: str = "42"
    # top-k sizes
    top_categories: int = 10
    top_sessions: int = 10
    top_products: int = 3
    # ad stream
    blacklist_threshold: int = 100
    top_ads: int = 3

    @property
    def professional_list(self):
        return _csv(self.professionals)

    @property
    def city_list(self):
        return _csv(self.cities)

    @property
    def keyword_list(self):
        return _csv(self.keywords)

    @property
    def category_list(self):
        return _csv(self.category_ids)

    @property
    def flow(self) -> tuple[int, ...]:
        return tuple(int(p) for p in _csv(self.target_page_flow) or ())

    @classmethod
    def from_json(cls, obj: dict) -> "TaskParams":
        """Build from the JSON parameter object used by the original jobs."""
        names = {
            "startDate": "start_date", "endDate": "end_date",
            "startAge": "start_age", "endAge": "end_age",
            "professionals": "professionals", "cities": "cities", "sex": "sex",
            "keywords": "keywords", "categoryIds": "category_ids",
            "targetPageFlow": "target_page_flow",
            # run settings that the original jobs fix in their code
            "sampleSize": "sample_size", "sampleSeed": "sample_seed", "topCategories": "top_categories",
            "topSessions": "top_sessions", "topProducts": "top_products",
        }
        sizes = ("sample_size", "top_categories", "top_sessions", "top_products")
        kwargs = {}
        for src, dst in names.items():
            if src not in obj:
                continue  # absent: keep the default
            v = obj.get(src)
            if v is None or (isinstance(v, str) and v.strip() == ""):
                if dst not in (*sizes, "sample_seed"):  # an empty size keeps its default
                    kwargs[dst] = None if dst != "target_page_flow" else ""
            elif dst in ("start_age", "end_age", *sizes):
                kwargs[dst] = int(v)
            else:
                kwargs[dst] = str(v)
        return cls(**kwargs)


def read_properties(text: str) -> dict[str, str]:
    """Java ``.properties`` text -> dict: ``#``/``!`` comments, ``=`` or ``:``
    separators, backslash line continuations."""
    props: dict[str, str] = {}
    logical, buf = [], ""
    for raw in text.splitlines():
        line = raw.strip() if not buf else raw.lstrip()
        if not buf and (not line or line[0] in "#!"):
            continue
        if line.endswith("\\") and not line.endswith("\\\\"):
            buf += line[:-1]
            continue
        logical.append(buf + line)
        buf = ""
    if buf:
        logical.append(buf)
    for line in logical:
        m = re.match(r"([^=:\s]+)\s*[=:]\s*(.*)$", line)
        if m:
            props[m.group(1)] = m.group(2).strip()
    return props


def _relaxed_json(text: str) -> dict:
    """JSON whose object keys may be unquoted (``{startAge: 20, ...}``); quoted
    text is passed over whole."""
    quoted = re.sub(r'"(?:[^"\\]|\\.)*"|([{,]\s*)([A-Za-z_][A-Za-z0-9_]*)\s*:',
                    lambda m: f'{m[1]}"{m[2]}":' if m[2] else m[0], text)
    return json.loads(quoted)


def params_from_properties(source: str, key: str = "task.params.json") -> TaskParams:
    """``TaskParams`` from a properties file (path or text) whose ``key`` holds
    the JSON parameter object, as the original jobs were configured."""
    text = open(source, encoding="utf-8").read() if os.path.exists(source) else source
    return TaskParams.from_json(_relaxed_json(read_properties(text)[key]))


# Parameters used by the registered queries on the derived fixture
# (January 2024, age 20-50, other filters empty, flow 1..7, N = 1000,
# blacklist threshold 2).
FIXTURE_PARAMS = TaskParams(start_date="2024-01-01", end_date="2024-01-31", start_age=20, end_age=50,
                            sample_size=1000, blacklist_threshold=2)
