"""Identity-audit events to a partitioned security lake, as PySpark jobs."""

from auditlake.plans.compiler import CompiledMapping, compile_mapping
from auditlake.plans.mapping import EventMapping, MappingError, load_mapping

__all__ = ["CompiledMapping", "EventMapping", "MappingError", "compile_mapping", "load_mapping"]
