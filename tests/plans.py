"""Physical plans as text."""

import io
from contextlib import redirect_stdout


def final_plan(df) -> str:
    """The formatted physical plan of a query."""
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
