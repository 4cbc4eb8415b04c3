"""Plans: the load job (``emberwake.plans.load``) and the query catalogue
(``emberwake.plans.catalog``). The job function is ``emberwake.plans.load.load``;
it is not re-exported here, so the submodule name stays the module."""

from emberwake.plans.load import LoadResult, LoadSpec, open_source, stage_as_csv

__all__ = ["LoadResult", "LoadSpec", "open_source", "stage_as_csv"]
