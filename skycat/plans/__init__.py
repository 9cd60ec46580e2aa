"""The catalogue build and the registered queries."""
