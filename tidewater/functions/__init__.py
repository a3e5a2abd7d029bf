"""Column -> Column building blocks."""

from .casts import (NUMERIC, date_of, epoch_to_timestamp, int_or_default, safe_cast,  # noqa: F401
                    strict_cast, to_date_coerce, to_numeric_coerce)
from .json import (NOT_ONE_DOCUMENT, default_if_missing, document_objects, int_of_json, is_one_document,  # noqa: F401
                   json_kind, json_query, json_query_array, json_rewritten, json_text, json_value, rejected_items,
                   root_items, safe_parse, strict_parse, text_kind)
from .keys import iso_utc, location_key, md5_hex, natural_key, row_id  # noqa: F401
from .text import (basename, greeting, initcap_sql, lower, rstrip_slash, sha256_prefix,  # noqa: F401
                   strip_json_suffix, title_python)
from .time import compact_stamp, fallback, now_or, utc_stamp, yesterday  # noqa: F401
