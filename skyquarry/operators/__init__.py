"""Operators on maps, catalogs and light curves."""
