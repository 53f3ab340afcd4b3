"""Staging, marts, exports and the daily runs built from the operators."""
