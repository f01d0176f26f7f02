"""Column -> Column functions: lenient JSON readers and text helpers."""

from quire.functions.lenient import (  # noqa: F401
    author_role_keys,
    field,
    first,
    identifiers,
    int_array,
    key_ref_array,
    lenient_int,
    lenient_string,
    parse_record,
    ref_key,
    short_key,
    string_array,
    text_or_value,
    trim_ws,
)
from quire.functions.text import (  # noqa: F401
    base_slug,
    clamp_chars,
    compose_slug,
    edition_base_slug,
    extract_year,
    run_timestamp,
    slugify,
    split_slug,
)
