"""Helpers of the tests in this folder (a module name that no other folder uses)."""


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
