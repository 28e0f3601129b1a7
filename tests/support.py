"""Helpers of the tests."""


def rows(df):
    """All rows as tuples in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    """Text of the plan Spark would run."""
    return df._jdf.queryExecution().executedPlan().toString()
