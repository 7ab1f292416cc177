"""The bronze, clean and mart tables as DataFrame plans."""
