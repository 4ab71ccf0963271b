"""What tests ask of plans."""


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
