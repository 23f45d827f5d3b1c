"""DataFrame operators. All are lazy but the two scans of ``leaks``, which stage counted cells and the parts of the values."""
