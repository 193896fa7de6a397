"""Column builders: nothing here runs a job."""
