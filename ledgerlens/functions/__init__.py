"""Functions: shared expressions (``expressions``), exact decimal moments
(``exact``) and order-dependent numbering that never gathers a group into
one task (``ranking``)."""
