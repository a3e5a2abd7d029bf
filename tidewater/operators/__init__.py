"""DataFrame -> DataFrame steps."""

from .dedup import deduplicate, parse_order_by, rank_spread, rank_within, total_order  # noqa: F401
from .filters import where_equal, where_like, where_not_null, where_rank_one  # noqa: F401
from .quality import ColumnTest, accepted_values, not_null, run_suite, tested_write, unique  # noqa: F401
from .unnest import (explode_strict, explode_tolerant, keep_array_roots, keep_objects,  # noqa: F401
                     quarantine, unnest, unnest_path)
from .aggregate import distinct_per_group, group_stats  # noqa: F401
from .project import except_columns, rename, struct_fields, with_product  # noqa: F401
