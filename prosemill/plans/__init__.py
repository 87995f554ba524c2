"""The four end-to-end jobs: profile, stage 1, cleaning, features."""
