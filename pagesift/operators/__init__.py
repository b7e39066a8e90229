"""DataFrame -> DataFrame operators: matching (``match``), run reconciliation (``runs``),
output statistics (``outputs``), log mining (``logs``), job accounting (``jobs``), the run
report (``report``) and the size-checked broadcast helper (``joins``)."""
