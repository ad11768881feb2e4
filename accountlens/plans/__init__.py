"""The jobs: resolution, classification, marts, reports and checks."""
