"""DataFrame -> DataFrame operators.

stage     D1-D4 record projections, E1-E7 filters and scan accounting
merge     G1 dedup, B1-B8 joins, M1-M5 refresh/insert/upsert, M9/M10 counters
rank      W1 skew-safe numbering within groups, M6 dense stable ids
joins     lookup joins with hot keys split off
checks    M11 integrity rules
schemas   live and staged table schemas
"""
