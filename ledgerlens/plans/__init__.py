"""Plans: how the operators are put together.

* ``catalogue`` -- every registered query over the benchmark tables;
* ``oracle``    -- their DuckDB SQL twins for the correctness check;
* ``jobs``      -- file-based fit / score jobs, one written table per stage.
"""
