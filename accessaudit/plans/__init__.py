"""The end-to-end audit and the registered queries."""
