"""Reusable DataFrame operators.

None of them holds a whole group in one task: groups are aggregated before they
are shuffled, long ordered groups are cut into range partitions, and only rows
whose number is bounded by construction are broadcast.
"""
