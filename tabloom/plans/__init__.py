"""Plan reports and the catalogue of registered queries."""
