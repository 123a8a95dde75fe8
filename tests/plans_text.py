"""Helpers to look at physical plans in tests."""


def final_plan(df) -> str:
    """The plan as it ran; call an action on the same frame first."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
