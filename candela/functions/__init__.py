from candela.functions.columns import (  # noqa: F401
    bool_to_int,
    bucket_above,
    flag_if_abs_above,
    pct_change,
    safe_div,
    sign_vs,
)
