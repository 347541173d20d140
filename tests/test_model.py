"""Loads of random messy sheets against a row-at-a-time model in plain Python."""

from __future__ import annotations

import json
import random
import re
from collections import Counter
from datetime import date, datetime

import pytest

from sheetmill.model import FeedConfig
from sheetmill.plans.load import load_feeds
from sheetmill.rules import RuleSet
from sheetmill.sources.tables import Warehouse

RULES = RuleSet.reference()
CELLS = {
    "date": ["1/2/2024", "12/31/99", "2/30/2024", "5-Jan-2024", "2024-01-05", " 3/4/24 ", "", "x"],
    "iso": ["2024-01-05", "2023-12-31", "1/2/2024", "", "n/a"],
    "number": ["1", "2.50", "7%", "1,234", "-3", "", " 8 ", "9\n", "0.1", "abc", "1,2,3%"],
    "whole": ["1", "2", "3", "", "x"],
    "text": ["a", "A", " b\nb ", "|", "", "\xa0c", "NULL", "None"],
}
HEADERS = ["Id", " Id", "Total (IDR)", "", "Ünit", "total_idr", "x__y", "X-Y", "_z_"]


def random_sheet(seed: int) -> list[list[str]]:
    rng = random.Random(seed)
    width = rng.randint(2, 6)
    kinds = [rng.choice(list(CELLS)) for _ in range(width)]
    rows = [rng.sample(HEADERS, width)]
    for _ in range(rng.randint(5, 60)):
        row = [rng.choice(CELLS[kind]) for kind in kinds]
        rows.append(row[: rng.randint(0, width)] if rng.random() < 0.15 else row)
    return rows


def matches(pattern: str, value: str) -> bool:
    return re.search(pattern.replace(r"\z", r"\Z"), value) is not None


class Model:
    """What a load should produce, one row after the other."""

    def __init__(self, rows, n_keys):
        used = Counter()
        self.names = []
        for header in rows[0]:
            name = "_".join(re.findall("[A-Za-z0-9]+", header)).lower() or "col"
            self.names.append(f"{name}_{used[name]}" if used[name] else name)
            used[name] += 1
        width = len(self.names)
        self.tmp = [
            [c.replace("\n", " ").strip() or None for c in (row + [""] * width)[:width]]
            for row in rows[1:]
        ]
        groups = [self.group([row[i] for row in self.tmp]) for i in range(width)]
        self.dates = [n for n, g in zip(self.names, groups, strict=True) if g == "DATE"]
        self.numbers = [n for n, g in zip(self.names, groups, strict=True) if g in ("INT64", "FLOAT")]
        self.keys = self.names[:n_keys]
        self.run()

    @staticmethod
    def group(cells):
        votes = Counter()
        for cell in filter(None, cells):
            if matches(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z", cell):
                votes["DATE"] += 1
            elif matches(r"^[0-9]+\z", cell):
                votes["INT64"] += 1
            elif matches(r"^[0-9]+(\.[0-9]+)?%?\z", cell):
                votes["FLOAT"] += 1
            else:
                votes["STRING"] += 1
        return max(votes, key=votes.get) if votes else "STRING"

    def run(self):
        self.dw, self.rejects, self.leaked = [], [], 0
        survivors = {}
        for cells in self.tmp:
            row = dict(zip(self.names, cells, strict=True))
            text = "|".join(c or "" for c in cells)
            typed = [(n, row[n]) for n in self.dates + self.numbers if row[n]]
            accept = {n: RULES.accept_date for n in self.dates}
            accept |= {n: RULES.accept_numeric for n in self.numbers}
            refuse = {n: RULES.reject_date for n in self.dates}
            refuse |= {n: RULES.reject_numeric for n in self.numbers}
            if all(matches(accept[n], v) for n, v in typed):
                values = [self.value(n, row[n]) for n in self.names]
                key = tuple(values[: len(self.keys)])
                if key in survivors:
                    detail = "|".join(
                        f"{k}: {self.text(v)}" for k, v in zip(self.keys, key, strict=True)
                    )
                    self.rejects.append((text, "DUPLICATE RECORD", detail))
                else:
                    survivors[key] = True
                    self.dw.append(tuple(values))
            elif failing := [f"{n}: {v}" for n, v in typed if not matches(refuse[n], v)]:
                self.rejects.append((text, "DATATYPE MISMATCH", "|".join(failing)))
            else:
                self.leaked += 1

    def value(self, name, cell):
        if cell is None:
            return None
        if name in self.dates:
            try:
                month, day, year = map(int, cell.split("/"))
                if len(cell.split("/")[2]) == 2:
                    year += 1900 if year >= 69 else 2000
                return date(year, month, day)
            except ValueError:
                return None
        if name in self.numbers:
            number = float(cell.replace(",", "").rstrip("%"))
            return number / 100 if cell.endswith("%") else number
        return cell

    @staticmethod
    def text(value):
        if value is None:
            return "NULL"
        whole = isinstance(value, float) and value == int(value)
        return str(int(value)) if whole else str(value)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    from sheetmill.model import RunContext

    folder = tmp_path_factory.mktemp("random")
    sheets = {}
    for seed in range(40):
        rows = random_sheet(seed)
        names = Model(rows, 1).names
        if len(set(names)) == len(names):
            sheets[f"f{seed}"] = rows
    configs = []
    for i, (feed, rows) in enumerate(sheets.items()):
        (folder / "sheets" / feed).mkdir(parents=True)
        (folder / "sheets" / feed / "s.json").write_text(json.dumps({"values": rows}))
        tables = {layer: f"{layer}.{feed}" for layer in FeedConfig.LAYERS}
        keys = Model(rows, 1 + i % 2).keys
        configs.append(FeedConfig(feed, tables, tuple(keys)))
        if len(configs) == 12:
            break
    warehouse = Warehouse(spark, str(folder / "wh"))
    ctx = RunContext.of("run_1", "20240105", datetime(2024, 1, 5, 7))
    results = load_feeds(spark, str(folder / "sheets"), configs, ctx, warehouse, RULES, parallel=8)
    return warehouse, [(c, sheets[c.job_name], results[c.job_name]) for c in configs]


def test_random_sheets(loaded):
    warehouse, feeds = loaded
    routes = Counter()
    for config, rows, result in feeds:
        model = Model(rows, len(config.primary_key))
        assert result.error is None, config
        assert result.schema.definition == tuple(model.names)
        assert result.schema.date == tuple(model.dates), config
        assert result.schema.numeric == tuple(model.numbers), config
        dw = warehouse.read(config.tables["dw"]).select(*model.names).collect()
        assert Counter(map(tuple, dw)) == Counter(model.dw), config
        rejects = warehouse.read_rejects(config.tables["rej"])
        got = [(r["row"], r.rej_reason, r.rej_detail) for r in rejects.collect()]
        assert Counter(got) == Counter(model.rejects), config
        routes.update(reason for _, reason, _ in model.rejects)
        routes.update(dw=len(model.dw), leaked=model.leaked, dates=len(model.dates))
    assert min(routes[r] for r in ("DUPLICATE RECORD", "DATATYPE MISMATCH", "dw", "leaked", "dates")) > 0
