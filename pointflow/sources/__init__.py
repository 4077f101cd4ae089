"""Inputs and outputs: text lines, labelled points, generated blobs, stream items."""
