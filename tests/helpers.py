"""Small frames and readable rows."""

import datetime as dt
import io
from contextlib import redirect_stdout

T = [dt.datetime(2024, 1, day) for day in range(1, 10)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df, mode="formatted"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def final_plan(df):
    """The plan after the run, with the decisions taken at run time."""
    df.collect()
    return plan(df, "simple").split("Initial Plan")[0]
