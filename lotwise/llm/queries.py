"""All queries of this folder."""

from lotwise.llm import queries_models, queries_native, queries_pairs, queries_streams  # noqa: F401
from lotwise.llm.registry import QUERIES, SQL  # noqa: F401
