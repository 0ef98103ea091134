"""Plans as text. Not in conftest.py, a name that tests/llm has too."""


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
