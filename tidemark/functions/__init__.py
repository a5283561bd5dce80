from tidemark.functions.scalars import (  # noqa: F401
    completeness_score,
    normalize_email,
    normalize_government_id,
    present,
    valid_email,
    valid_phone,
)
