from .columns import (  # noqa: F401
    METADATA_VALID_END,
    METADATA_VALID_START,
    MINTED_ID_THRESHOLD,
    covers,
    date_lit,
    id_text,
    is_numeric_text,
    joined_description,
    left,
    non_blank,
    parse_number,
    pg_concat,
    slug,
    typed_null,
)
