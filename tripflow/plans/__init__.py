"""Compositions: lazy layer chains, the on-disk medallion run, SQL forms, registered queries."""
