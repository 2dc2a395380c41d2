"""The end-to-end batch run and the registered queries."""
