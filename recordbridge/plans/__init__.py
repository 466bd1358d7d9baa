"""The transfer jobs: each builds one import table or one report as a lazy plan."""
