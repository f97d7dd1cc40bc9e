"""Randomised check of record parsing against a small pure-Python model of the
record semantics (one Spark job over ~2000 generated records)."""

import calendar
import datetime as dt
import math
import random
import re

import numpy as np

from blotter.functions.parse import parse_records
from tests.conftest import records_df

DATE_RE = re.compile(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$")
FLOAT_RE = re.compile(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")


def model_date(s):
    if s is None or not DATE_RE.match(s):
        return None
    try:
        day = min(int(s[8:10]), calendar.monthrange(int(s[:4]), int(s[5:7]))[1]) if 1 <= int(s[8:10]) <= 31 else 0
        return dt.datetime.strptime(f"{s[:8]}{day:02d}{s[10:-1]}", "%Y-%m-%dT%H:%M:%S.%f")
    except (ValueError, IndexError):        # calendar errors are ValueErrors
        return None                         # no such month, or a day over 31


def model_district(s):
    if s is None:
        return None
    t = s.strip()
    if t in ("NaN", "+NaN", "-NaN"):
        return 0
    if not FLOAT_RE.match(t):
        return None
    x = float(np.float32(float(t)))
    if math.isinf(x):
        return 2 ** 31 - 1 if x > 0 else -(2 ** 31)
    return int(max(-(2 ** 31), min(2 ** 31 - 1, math.floor(x + 0.5))))


def model(line):
    """-> ('drop',) | ('reject',) | ('ok', row)"""
    f = line.split(",")
    if len(f) > 5 and f[5] == '""':
        return ("drop",)
    key = line.split(",", 1)[0] if "," in line else None
    ident = int(key) if key is not None and re.match(r"^[+-]?\d+$", key) and \
        -(2 ** 63) <= int(key) < 2 ** 63 else None
    if len(f) < 6:
        return ("reject",)
    date, district = model_date(f[1]), model_district(f[5])
    if ident is None or date is None or district is None:
        return ("reject",)
    return ("ok", (ident, date, f[2], f[3].lower() == "true", f[4].lower() == "true", district))


def gen_line(rnd, i):
    key = rnd.choice([str(i), str(i), str(i), f"+{i}", f" {i}", f"{i}.0", "x"])
    y, mo, d = rnd.randint(1990, 2030), rnd.randint(1, 12), rnd.randint(1, 31)
    date = f"{y:04d}-{mo:02d}-{d:02d}T{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:" \
           f"{rnd.randint(0, 59):02d}.{rnd.randint(0, 999):03d}Z"
    date = rnd.choice([date] * 6 + [date[:-5] + "Z", date[:-1] + "+01:00", date.lower(), date + " "])
    code = rnd.choice(["0110", "0141", "110", "", "031A"])
    flag = lambda: rnd.choice(["True", "False", "TRUE", "true", "t", "1", "", "yes", "fAlSe"])
    dist = rnd.choice([f"{rnd.randint(-30, 30)}.{rnd.choice([0, 5, 49, 51])}", '""', "", " 7.0 ",
                       "NaN", "1e1", "-0.5", "abc", str(rnd.randint(0, 99)), "2.5000001"])
    fields = [key, date, code, flag(), flag(), dist, "1.0", "41.8", "-87.6"]
    cut = rnd.choice([9] * 8 + [3, 5, 6])
    return ",".join([str(i)] + fields[1:cut]) if key == "x" and cut < 9 else ",".join(fields[:cut])


def test_parse_matches_model(spark):
    rnd = random.Random(20240131)
    lines = [gen_line(rnd, i) for i in range(2000)]
    good, rej = parse_records(records_df(spark, lines))
    got_good = sorted((r.id, r.date, r.iucr_code, r.arrest, r.domestic, r.district) for r in good.collect())
    got_rej = sorted(r.value for r in rej.collect())
    exp = [(ln, model(ln)) for ln in lines]
    exp_good = sorted(m[1] for _, m in exp if m[0] == "ok")
    exp_rej = sorted(ln for ln, m in exp if m[0] == "reject")
    assert len(exp_good) > 300 and len(exp_rej) > 100            # both paths exercised
    assert got_rej == exp_rej
    assert got_good == exp_good
