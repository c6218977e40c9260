"""Part of skylattice."""
