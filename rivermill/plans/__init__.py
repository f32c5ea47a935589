"""The warehouse jobs: one function per job, batch and stream alike unless said otherwise."""
