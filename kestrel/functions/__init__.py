"""See the package docstring of :mod:`kestrel`."""
