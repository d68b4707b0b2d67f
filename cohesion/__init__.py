"""cohesion: declarative harmonisation of wide longitudinal tables on Spark.

One spec per target entity is compiled into lazy DataFrame operations and
Column expressions; see ``map_entity`` and ``map_study``.
"""

from .plans.engine import EntityResult, map_entity, map_study
from .spec import EntitySpec, load_spec, load_study

__all__ = ["EntityResult", "EntitySpec", "load_spec", "load_study", "map_entity", "map_study"]
