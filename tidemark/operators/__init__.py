"""Relational operators: latest and winners, merges, match cascades, gates, expectations, rules and the entity life cycle."""
