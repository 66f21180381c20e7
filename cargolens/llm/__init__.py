"""Training-data operators: extraction, scoring, sharding, filtering,
packing, counting, de-duplication, mixing and search over text tables.

Nothing outside this subpackage imports it. The registered queries are in
``cargolens.llm.queries``.
"""
