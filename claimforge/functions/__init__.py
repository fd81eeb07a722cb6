"""Column functions of the engine: every one takes and returns Columns, none is a Python UDF."""

from claimforge.functions.normalize import (  # noqa: F401
    clean_text,
    initcap_words,
    normalize_category,
    normalize_gender,
    normalize_id,
    normalize_phone,
    normalize_postal,
    normalize_province,
    postal_province,
)
from claimforge.functions.parse import (  # noqa: F401
    parse_amount,
    parse_boolean,
    parse_date,
    parse_integer,
    parse_timestamp,
    text_array,
)
from claimforge.functions.shape import age_band, age_years, contains_all, is_weekend, length_or_null  # noqa: F401
