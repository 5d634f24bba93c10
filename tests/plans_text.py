"""Physical plans as text."""

import contextlib
import io


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
